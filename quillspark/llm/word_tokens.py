"""Token ids of whole texts by a public tokenizer file, with a cache of words.

For a tokenizer that drops white space before it splits (NFC, white space to one space, lower case; then runs of
letters, single digits, runs of the rest), the ids of a text are those of its words one after another, so each worker
keeps the ids of words it has met. For any other tokenizer file the library encodes whole texts.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

#: Fixed value: the split pattern for which the ids of a text are those of its words.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A plain word: Latin-1 letters that lower-case one to one, then ASCII punctuation; two pieces of the split at most.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-/:-@\[-`{-~]*)")
#: Separators that Python takes for white space and the tokenizer doesn't.
ODD_SPACE = re.compile(r"[\x1c-\x1f]")
CACHED_WORDS = 250_000


class WordTokens:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        norm, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps, parts = norm.get("normalizers", []), split.get("pretokenizers", [])
        self.by_word = (
            [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
            and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
            and [x["type"] for x in parts] == ["Split", "ByteLevel"]
            and (parts[0]["pattern"], parts[0]["behavior"], parts[0]["invert"]) == ({"Regex": WORD_SPLIT}, "Removed", True)
            and not parts[1]["add_prefix_space"]
            and not spec.get("post_processor")
            and not any(set(x["content"]) & set(" \t\n") or x["lstrip"] or x["rstrip"] for x in spec.get("added_tokens", []))
        )
        self.words: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {"": b""}
        # Byte-level letters: printable bytes stand for themselves, the others for code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = (b for b in range(256) if b not in set(shown))
        self.letters = str.maketrans({chr(b): chr(256 + k) for k, b in enumerate(hidden)})

    def _core(self, core: str) -> bytes:
        found = self.cores.get(core)
        if found is None:
            mapped = core.encode().decode("latin-1").translate(self.letters)
            found = np.array([x.id for x in self.tokenizer.model.tokenize(mapped)], "<u4").tobytes()
            if len(self.cores) >= CACHED_WORDS:
                self.cores = {"": b""}
            self.cores[core] = found
        return found

    def _word(self, word: str) -> bytes:
        plain = PLAIN.fullmatch(word)
        if plain:
            return self._core(plain[1].lower()) + self._core(plain[2])
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if not self.by_word or ODD_SPACE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.split()
        cache = self.words
        try:
            return b"".join([cache[w] for w in words])
        except KeyError:
            pass
        if len(cache) > CACHED_WORDS:
            cache.clear()
        out = []
        for w in words:
            found = cache.get(w)
            if found is None:
                found = self._word(w)
                if len(w) < 64:
                    cache[w] = found
            out.append(found)
        return b"".join(out)


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One for each worker process and file."""
    return WordTokens(path)
