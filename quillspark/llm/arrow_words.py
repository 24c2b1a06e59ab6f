"""The words `[^\\x20\\x09-\\x0D]+` of many texts as numbers, exact and without Python objects for single words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in runs of about so many bytes.
RUN_BYTES = 2_000_000


def runs_of(texts: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(place of the first, texts) in runs of about `limit` bytes; a null text is the empty one. A longer text is a run of its own."""
    filled = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(filled).to_numpy(zero_copy_only=False), dtype="i8")
    at = 0
    while at < len(filled):
        before = ends[at - 1] if at else 0
        after = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield at, filled[at:after]
        at = after


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(numbers, first, dictionary): equal words of these texts have equal numbers, their places in the dictionary.

    The words of text k are first[k] to first[k + 1].
    """
    listed = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    first = listed.offsets.to_numpy().astype("i8")
    encoded = listed.flatten().dictionary_encode()
    numbers = encoded.indices.to_numpy().astype("i8")
    # A text without a word comes out as one empty word.
    none = np.flatnonzero(pc.binary_length(pc.ascii_trim_whitespace(texts)).to_numpy(zero_copy_only=False) == 0)
    first -= first[0]
    if len(none):
        numbers = np.delete(numbers, first[none])
        gone = np.zeros(len(first), "i8")
        gone[none + 1] = 1
        first = first - np.cumsum(gone)
    return numbers, first, encoded.dictionary


def owners(first: np.ndarray) -> np.ndarray:
    """For each word the text that it stands in."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
