"""Runs of periodic words: tandem repeats in linear size, merged into maximal runs.

The method of Gusfield and Stoye over the words of many texts at once. The blocks of the Lempel-Ziv factorisation give a
covering set of the leftmost squares, two families of candidates for each block, decided by how far the text agrees
ahead and back. From these, walks along suffix links (a square's first word is moved to its end) complete the vocabulary
of squares. Every occurrence of a square of the vocabulary is then located in the order of suffixes, and occurrences of
one period that follow each other merge into a run. Squares of a root that is itself a power are left to the smaller
period, so at most n log n occurrences are located, and a text of one repeated word is no worse than another.

Suffix tree, suffix links and the questions how far two places agree are answered from one structure: for each power of
two the rank of the words from each place on, which is what sorting the suffixes by doubling leaves behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.arrow_words import owners, runs_of, word_numbers
from quillspark.llm.wordhash import STEP, mix

#: A run has so many words at least, and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Texts are put together for the suffix order until they have so many words; a longer text stands alone.
TOGETHER = 120_000


class Suffixes:
    """Sorted suffixes of a sequence of numbers, with the rank of every 2**t symbols from each place on."""

    def __init__(self, symbols: np.ndarray) -> None:
        n = self.n = len(symbols)
        self.symbols = symbols
        order = np.argsort(symbols, kind="stable")
        head = np.ones(n, bool)
        head[1:] = symbols[order[1:]] != symbols[order[:-1]]
        kind = "i4" if n < 1 << 31 else "i8"
        rank = np.full(n + 1, -1, kind)
        rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
        self.ranks, size = [rank], 1
        slots = _shared(head, np.arange(n))
        while len(slots):
            at = order[slots]
            key = rank[at].astype("i8") * (n + 2) + rank[np.minimum(at + size, n)] + 1
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            order[slots] = at
            head = np.ones(len(at), bool)
            head[1:] = key[1:] != key[:-1]
            rank = rank.copy()
            rank[at] = slots[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
            self.ranks.append(rank)
            slots = _shared(head, slots)
            size *= 2
        self.order = order

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i and from j on agree."""
        same, out = i == j, np.zeros(len(i), "i8")
        j = np.where(same, self.n, j)
        for t in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[t]
            out += (rank[i + out] == rank[np.minimum(j + out, self.n)]).astype("i8") << t
        return np.where(same, self.n - i, out)

    def back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols up to i and up to j agree, for i < j."""
        out = np.zeros(len(i), "i8")
        for t in range(len(self.ranks) - 1, -1, -1):
            rank, a = self.ranks[t], i - out - (1 << t) + 1
            out += ((a >= 0) & (rank[np.maximum(a, 0)] == rank[np.maximum(j - i + a, 0)])).astype("i8") << t
        return out

    def named(self, i: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two numbers that, with `length`, are the same for equal stretches only."""
        t = np.minimum(_log2(length), len(self.ranks) - 1)
        # Beyond the longest repeat every stretch is known by its first 2**t symbols.
        head, tail = np.zeros(len(i), "i8"), np.zeros(len(i), "i8")
        for k in np.unique(t).tolist():
            at = t == k
            head[at] = self.ranks[k][i[at]]
            tail[at] = self.ranks[k][np.maximum(i[at], i[at] + length[at] - (1 << k))]
        return head, tail

    def earlier(self) -> np.ndarray:
        """For each place how long a stretch from there on also begins at an earlier place."""
        most = np.zeros(self.n, "i8")
        for way in (self.order, self.order[::-1]):
            # The nearest suffix in order that begins earlier, by jumps over those that were passed already.
            to = np.arange(-1, self.n - 1)
            todo = np.flatnonzero(to >= 0)
            while len(todo := todo[(to[todo] >= 0) & (way[to[todo]] > way[todo])]):
                to[todo] = to[to[todo]]
            has = to >= 0
            at = way[has]
            most[at] = np.maximum(most[at], self.ahead(at, way[to[has]]))
        return most

    def occurrences(self, i: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(low, high): the suffixes order[low] to order[high - 1] begin with the stretch."""
        rank = self.ranks[-1][i].astype("i8")
        low = _first(np.zeros(len(i), "i8"), rank, lambda m: self.ahead(self.order[m], i) >= length)
        high = _first(rank + 1, np.full(len(i), self.n), lambda m: self.ahead(self.order[m], i) < length)
        return low, high

    def moved(self, i: np.ndarray, length: np.ndarray) -> np.ndarray:
        """A place of the stretch less its first symbol, followed by that symbol; -1 where it stands nowhere."""
        rest, first = i + 1, self.symbols[i]

        def reached(m: np.ndarray) -> np.ndarray:
            at = self.order[m]
            same = self.ahead(at, rest)
            whole = same >= length - 1
            own, other = at + np.minimum(same, length - 1), rest + same
            last = np.where(own < self.n, self.symbols[np.minimum(own, self.n - 1)], -1)
            wanted = np.where(whole, first, np.where(other < self.n, self.symbols[np.minimum(other, self.n - 1)], -1))
            return last >= wanted

        at = _first(np.zeros(len(i), "i8"), np.full(len(i), self.n), reached)
        found = self.order[np.minimum(at, self.n - 1)]
        end = found + length - 1
        fits = (at < self.n) & (end < self.n) & (self.ahead(found, rest) >= length - 1)
        return np.where(fits & (self.symbols[np.minimum(end, self.n - 1)] == first), found, -1)


def _shared(head: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The slots of groups of two or more; head marks where a group begins."""
    last = np.append(head[1:], True) if len(head) else head
    return slots[~(head & last)]


def _log2(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype("f8"))[1].astype("i8") - 1


def _first(low: np.ndarray, high: np.ndarray, holds) -> np.ndarray:
    """The least m in [low, high] for which `holds`, which from some m on is true; it isn't asked for high."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        mid = np.where(open_, (low + high) // 2, 0)
        true = holds(mid)
        high = np.where(open_ & true, mid, high)
        low = np.where(open_ & ~true, mid + 1, low)
    return low


def _spread(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k, 0 to sizes[k] - 1) for every k."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def blocks(earlier: np.ndarray) -> np.ndarray:
    """Where the blocks of the Lempel-Ziv factorisation begin, and the end."""
    step, at, found = np.maximum(earlier, 1).tolist(), 0, []
    while at < len(step):
        found.append(at)
        at += step[at]
    return np.array([*found, len(step)], "i8")


def covering_squares(s: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of squares that cover the leftmost ones: every square's leftmost occurrence is reached by moving one of these along."""
    edges = blocks(s.earlier())
    begin, end = edges[:-1], edges[1:]
    following = np.append(end[1:], s.n)
    starts, halves = [], []
    # The centre is in the block and the square goes on into the next one.
    of, k = _spread(np.where(end < s.n, end - begin, 0))
    edge, half = end[of], k + 1
    may = s.symbols[edge - half] == s.symbols[edge]
    edge, half = edge[may], half[may]
    q = edge - half
    on, off = s.ahead(edge, q), np.where(q > 0, s.back(np.maximum(q - 1, 0), edge - 1), 0)
    good = (on > 0) & (on + off >= half)
    starts.append(np.maximum(q - off, q - half + 1)[good])
    halves.append(half[good])
    # The square begins before the block.
    of, k = _spread(following - begin)
    at, half = begin[of], k + 1
    may = (at > 0) & (at + half < s.n)
    of, at, half = of[may], at[may], half[may]
    may = (s.symbols[at] == s.symbols[at + half]) & (s.symbols[at - 1] == s.symbols[at + half - 1])
    of, at, half = of[may], at[may], half[may]
    q = at + half
    on, off = s.ahead(at, q), s.back(at - 1, q - 1)
    start = np.maximum(at - off, at - half + 1)
    good = (on > 0) & (off > 0) & (on + off >= half) & (start + half <= end[of])
    starts.append(start[good])
    halves.append(half[good])
    return np.concatenate(starts), np.concatenate(halves)


def primitive(s: Suffixes, start: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Whether the half is no power of a shorter stretch."""
    good = np.ones(len(half), bool)
    most = int(half.max(initial=1))
    least = np.arange(most + 1)
    for p in range(2, int(most**0.5) + 1):
        if least[p] == p:
            at = np.arange(p * p, most + 1, p)
            least[at] = np.minimum(least[at], p)
    rest = half.copy()
    while (many := rest > 1).any():
        prime = least[rest]
        part = half // np.maximum(prime, 1)
        test = np.flatnonzero(many & good)
        i, d = start[test], part[test]
        good[test] = s.ahead(i, i + d) < half[test] - d
        rest = np.where(many, rest // np.maximum(prime, 1), 1)
    return good


def vocabulary(s: Suffixes, start: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half), once for each square that is a rotation of one of the given squares and stands in the text."""
    seen: set[tuple[int, int, int]] = set()
    starts, halves = [], []
    while len(start):
        a, b = s.named(start, 2 * half)
        fresh = [k for k, key in enumerate(zip(half.tolist(), a.tolist(), b.tolist(), strict=True)) if key not in seen]
        start, half = start[fresh], half[fresh]
        # Along its own run a square moves without being looked for.
        more = np.minimum(s.ahead(start, start + half) - half, half - 1)
        of, k = _spread(more + 1)
        i, h = start[of] + k, half[of]
        a, b = s.named(i, 2 * h)
        mine = []
        for at, key in enumerate(zip(h.tolist(), a.tolist(), b.tolist(), strict=True)):
            if key not in seen:
                seen.add(key)
                mine.append(at)
        starts.append(i[mine])
        halves.append(h[mine])
        ends = more < half - 1
        at, half = start[ends] + more[ends], half[ends]
        start = s.moved(at, 2 * half)
        start, half = start[start >= 0], half[start >= 0]
    return np.concatenate(starts) if starts else start, np.concatenate(halves) if halves else half


def all_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of two periods or more, by start and period."""
    none = np.zeros(0, "i8")
    if len(symbols) < 2:
        return none, none, none
    s = Suffixes(symbols)
    start, half = covering_squares(s)
    good = primitive(s, start, half)
    start, half = vocabulary(s, start[good], half[good])
    if not len(start):
        return none, none, none
    low, high = s.occurrences(start, 2 * half)
    of, k = _spread(high - low)
    at, period = s.order[low[of] + k], half[of]
    by = np.lexsort((at, period))
    at, period = at[by], period[by]
    head = np.ones(len(at), bool)
    head[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(at)) - 1
    start, period = at[first], period[first]
    length = at[last] - start + 2 * period
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def may_hold_runs(numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The texts that can hold a run of MIN_PERIODS periods and MIN_WORDS words at all; others are never among them.

    Such a run with a period under five repeats five words at most four places on; with a longer period it has the same
    five words four times. Both are seen on hashes, which may let texts through that hold no run, and never the reverse.
    """
    size, n = 5, len(numbers)
    if n < size + 1:
        return np.zeros(0, "i8")
    text = owners(first)
    mixed = mix(numbers.astype("u8") + np.uint64(1))
    rolled, factor = np.zeros(n - size + 1, "u8"), 1
    for k in range(size):
        rolled += mixed[k : k + len(rolled)] * np.uint64(factor)
        factor = factor * STEP % (1 << 64)
    inside = text[: len(rolled)] == text[size - 1 :]
    key = (text[: len(rolled)].astype("u8") << np.uint64(40)) | (mix(rolled) >> np.uint64(24))
    found = [text[: len(rolled) - d][(key[d:] == key[:-d]) & inside[d:] & inside[:-d]] for d in range(1, 5) if len(rolled) > d]
    key = np.sort(key[inside])
    found.append((key[3:][key[3:] == key[:-3]] >> np.uint64(40)).astype("i8"))
    return np.unique(np.concatenate(found)).astype("i8")


def text_runs(numbers: np.ndarray, first: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """For each text that has any its runs (start, length, period), by start and period."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    held: list[int] = []
    size = 0
    chosen = may_hold_runs(numbers, first).tolist()
    for k, text in enumerate(chosen):
        held.append(text)
        size += int(first[text + 1] - first[text])
        following = int(first[chosen[k + 1] + 1] - first[chosen[k + 1]]) if k + 1 < len(chosen) else TOGETHER
        if size + following > TOGETHER:
            sizes = np.array([first[t + 1] - first[t] for t in held], "i8")
            begin = np.append(0, np.cumsum(sizes))
            # A word of one text is another symbol than that of any other text, so nothing repeats across texts.
            joined = np.concatenate([numbers[first[t] : first[t + 1]] for t in held])
            whose = np.repeat(np.arange(len(held)), sizes)
            symbols = np.unique(whose * (int(numbers.max()) + 1) + joined, return_inverse=True)[1].astype("i8")
            start, length, period = all_runs(symbols)
            keep = length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
            start, length, period = start[keep], length[keep], period[keep]
            of = np.searchsorted(begin, start, side="right") - 1
            for t, a, b, c in zip(of.tolist(), (start - begin[of]).tolist(), length.tolist(), period.tolist(), strict=True):
                found.setdefault(held[t], []).append((a, b, c))
            held, size = [], 0
    return found


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("id", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in runs_of(batch.column(1)):
            found = text_runs(*word_numbers(texts)[:2])
            runs, collapsed = [], []
            for k, text in enumerate(texts):
                words, mine = text.as_py().encode().split(), found.get(k, [])
                if mine:
                    cut = np.zeros(len(words) + 1, "i8")
                    for start, length, period in mine:
                        cut[start + period] += 1
                        cut[start + length] -= 1
                    words = [words[i] for i in np.flatnonzero(np.cumsum(cut[:-1]) == 0).tolist()]
                runs.append(mine)
                collapsed.append(b" ".join(words).decode())
            listed = [x for mine in runs for x in mine]
            offsets = pa.array([0, *np.cumsum([len(mine) for mine in runs]).tolist()], pa.int32())
            parts = [pa.array([x[c] for x in listed], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + len(texts)], pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(parts, fields=list(RUN))), pa.array(collapsed, pa.string())], schema=FOUND)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, runs (start, length, period, numbered by words from 0, by start and period) and collapsed for each row of `docs`.

    Words are `[^\\x20\\x09-\\x0D]+`. A run is a stretch with smallest period q and max(6, 4 q) words or more that goes on
    as far as words q apart agree. collapsed is the text's words joined by one space, without those that any run holds
    after its first q. A null text has no words, like an empty one: no runs, and an empty collapsed text. Repeated rows
    come out each; a null id stays null; an empty table stays empty; other columns are ignored, whatever their names. Of
    a very long text some 300 bytes a word are held at once, and only if five of its words repeat as in a run.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = rows.mapInArrow(_find, "id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
