"""Quality scores by Bradley-Terry ranking.

All pairs of labelled documents, a good one over a bad one, train weights by logistic loss on the difference of
their features; a document's worth is the weighted sum of its own. The cut between bad and good is the quantile of
training worths at the share of bad documents, and the score is the logistic of the distance to it.

Features are counts of the surface (words, letters, repeats, lines) and hashed shares of words and of runs of three
characters, all of them of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import release, settle
from quillspark.llm.wordhash import Words, together

#: The preference pairs that train draws from a matrix; fit takes all pairs.
PAIRS = 100_000
#: Worths are counted in bins of one FINENESS-th, by their means, and in so many at most; curvature rests on COARSE bins.
FINENESS, BINS, COARSE = 64, 4096, 64
#: Newton steps of fit at most, and the step at which it ends; sums are merged in so many slices.
STEPS, LEAST_STEP, SLICES = 30, 1e-5, 16

NAMES = ("log_words", "word_bytes", "upper", "digit", "bang", "pipe", "symbol", "stop", "comma", "bracket", "slash", "quote", "distinct", "repeat_next", "top_word", "again5", "lines", "long_word", "short_text", "other")
#: Classes that the words, and the runs of three characters, of a text are hashed to: two to the power of 7.
HASHED = 128
WIDTH = len(NAMES) + 2 * HASHED
#: The ridge of the loss, and by how much hashed features are shrunk against those of the surface: they weigh little unless
#: many pairs agree on them.
RIDGE, SHRUNK = 1e-3, 0.1
_CLASS = np.zeros(256, "u1")
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?", b"|", b"#$%&*@^~+=_", b".", b",;:", b"()[]{}<>", b"/\\-", b"\"'`"), 1):
    _CLASS[list(_chars)] = _k


def features(texts: list[bytes]) -> np.ndarray:
    """A row for each text: NAMES, then the hashed shares of its words and of its runs of three characters."""
    words = Words(texts)
    n = len(texts)
    spans = np.diff(words.first)
    code = _CLASS[words.raw]
    counts = np.zeros((n, 11))
    for c in range(1, 11):
        where = np.flatnonzero(code == c)
        counts[:, c] = np.bincount(np.searchsorted(words.text_starts, where, "right") - 1, minlength=n)[:n]
    breaks = np.flatnonzero(words.raw == 10)
    lines = np.bincount(np.searchsorted(words.text_starts, breaks, "right") - 1, minlength=n)[:n] if n else np.zeros(0)
    size = np.maximum(1, words.text_ends - words.text_starts)
    some = np.maximum(1, spans)
    h = words.hashes
    lengths = words.ends - words.starts
    distinct, repeat_next, top, again, long_word = (np.zeros(n) for _ in range(5))
    shingles = words.shingles(5)
    for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
        if a == b:
            continue
        own = h[a:b]
        _, times = np.unique(own, return_counts=True)
        distinct[k] = len(times) / (b - a) ** 0.9
        repeat_next[k] = (own[1:] == own[:-1]).mean() if b - a > 1 else 0
        top[k] = times.max() / (b - a)
        again[k] = 1 - len(shingles[k]) / max(1, b - a - 4)
        long_word[k] = (lengths[a:b] > 24).mean()
    ratio = counts[:, 1:] / size[:, None]
    root = np.sqrt(ratio)
    other = root[:, [2, 3, 4]].max(axis=1, initial=0)
    surface = np.column_stack([np.log1p(spans), (size / some).clip(0, 40) / 10, root, distinct.clip(0, 3), np.sqrt(repeat_next), np.sqrt(top), np.sqrt(again.clip(0, 1)), np.sqrt(lines / some), np.sqrt(long_word), (spans < 20) * 1.0, other])
    return np.column_stack([surface, _shares((h >> np.uint64(32)).astype("i8") % HASHED, np.repeat(np.arange(n), spans), n), _shares(*_runs(words), n)]).astype("f4").astype("f8")


def _shares(classes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The roots of the shares that the HASHED classes have among those of each text."""
    counts = np.bincount(owner * HASHED + classes, minlength=n * HASHED)[: n * HASHED].reshape(n, HASHED)
    return np.sqrt(counts / np.maximum(1, counts.sum(axis=1, keepdims=True)))


def _runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The classes of all runs of three bytes inside a text, and whose they are."""
    raw = words.raw.astype("u4")
    if len(raw) < 3:
        return np.zeros(0, "i4"), np.zeros(0, "i4")
    codes = ((raw[:-2] | (raw[1:-1] << np.uint32(8)) | (raw[2:] << np.uint32(16))) * np.uint32(2654435761)) >> np.uint32(32 - 7)
    owner = np.repeat(np.arange(len(words.text_starts), dtype="i4"), words.text_ends - words.text_starts + 1)
    # No run begins at the last two bytes of a text or at the space after it.
    inside = np.ones(len(raw), bool)
    for back in range(3):
        inside[np.maximum(words.text_ends - back, words.text_starts)] = False
    inside = inside[:-2]
    return codes[inside].astype("i4"), owner[:-2][inside]


def train(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> dict:
    """Weights, scaling and cut from features and labels (1 good, 0 bad). With one kind of label only, worths are 0."""
    width = x.shape[1] if x.ndim == 2 and x.shape[1] else WIDTH
    mean, spread = (x.mean(axis=0), x.std(axis=0)) if len(x) else (np.zeros(width), np.ones(width))
    spread = np.where(spread > 1e-9, spread, 1.0) / np.where(np.arange(width) < len(NAMES), 1.0, SHRUNK)
    z = ((x - mean) / spread).clip(-8, 8)
    up, down = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    if not len(up) or not len(down):
        return {"w": np.zeros(width), "mean": mean, "spread": spread, "cut": 0.0 if len(up) >= len(down) else 1.0}
    rng = np.random.default_rng(seed)
    w = bradley_terry(z, rng.choice(up, pairs), rng.choice(down, pairs))
    worth = z @ w
    return {"w": w, "mean": mean, "spread": spread, "cut": float(np.quantile(worth, len(down) / len(z), method="midpoint"))}


def bradley_terry(z: np.ndarray, better: np.ndarray, worse: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """The weights w that minimise the mean of log(1 + exp(-w (z[better] - z[worse]))) plus ridge / 2 times |w|^2.

    Newton steps, each solved by conjugate gradients. Differences are never laid out: what a pair adds is gathered by
    document first.
    """
    w = np.zeros(z.shape[1])

    def over_pairs(c: np.ndarray) -> np.ndarray:
        return z.T @ (np.bincount(better, c, len(z)) - np.bincount(worse, c, len(z))) / len(better)

    for _ in range(50):
        worth = z @ w
        p = 1 / (1 + np.exp(np.clip(worth[better] - worth[worse], -30, 30)))
        gradient = ridge * w - over_pairs(p)
        curve = p * (1 - p)
        step, left = np.zeros_like(w), gradient.copy()
        way, size = left.copy(), left @ left
        if size < 1e-20:
            break
        for _ in range(100):
            along = z @ way
            bent = over_pairs(curve * (along[better] - along[worse])) + ridge * way
            rate = size / (way @ bent)
            step, left = step + rate * way, left - rate * bent
            old, size = size, left @ left
            if size < 1e-6 * (gradient @ gradient):
                break
            way = left + size / old * way
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def worths(x: np.ndarray, model: dict) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(((x - model["mean"]) / model["spread"]).clip(-8, 8) @ model["w"] - model["cut"], -30, 30)))


def _by_document(fn, schema: str):
    """A mapInArrow function: (id, text) to (id, fn(features))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in together(batch.column(0).to_pylist(), batch.column(1)):
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), fn(features(texts))], ["doc_id", schema])

    return run


def _standard(column: pa.Array, model: dict) -> np.ndarray:
    """Packed features, scaled as worths scales them."""
    x = np.frombuffer(b"".join(column.to_pylist()), "<f4").astype("f8").reshape(-1, WIDTH)
    return ((x - model["mean"]) / model["spread"]).clip(-8, 8)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, q) to the documents of each label and the sums of features and of their squares, a row for each task."""
    counts, sums = np.zeros(2), np.zeros((2, WIDTH))
    for batch in batches:
        x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f4").astype("f8").reshape(-1, WIDTH)
        counts += np.bincount(batch.column(1).to_numpy(), minlength=2)
        sums += [x.sum(axis=0), (x * x).sum(axis=0)]
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([counts, sums.ravel()]).tobytes()], pa.binary())], ["sums"])


def _counted(model: dict, fineness: int):
    """(x, q) to (q, bin, n, total) of the worths of each label in a bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            worth = _standard(batch.column(0), model) @ model["w"]
            keys, owner = np.unique(np.floor(worth * fineness).astype("i8") * 2 + batch.column(1).to_numpy(), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys & 1), pa.array(keys >> 1), pa.array(np.bincount(owner)), pa.array(np.bincount(owner, worth))], ["q", "bin", "n", "total"])

    return run


def _worth(model: dict):
    """(x, q) to worths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_standard(batch.column(0), model) @ model["w"])], ["worth"])

    return run


def _sloped(model: dict, grid: np.ndarray, slopes: np.ndarray, edges: np.ndarray, bends: np.ndarray):
    """(x, q) to slices of what a task's documents add to the gradient, to the curvature, and to the sums of features by coarse bin.

    `slopes` are for each label what a worth of `grid` meets in all documents of the other, `bends` likewise for coarse bins.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, bend, sums = np.zeros(WIDTH), np.zeros((WIDTH, WIDTH)), np.zeros((2 * COARSE, WIDTH))
        for batch in batches:
            if not len(batch):
                continue
            z, q = _standard(batch.column(0), model), batch.column(1).to_numpy()
            worth = z @ model["w"]
            slope += z.T @ np.where(q == 1, -np.interp(worth, grid, slopes[1]), np.interp(worth, grid, slopes[0]))
            at = q * COARSE + np.searchsorted(edges, worth, "right")
            bend += z.T @ (z * bends.ravel()[at][:, None])
            order = np.argsort(at, kind="stable")
            first = np.flatnonzero(np.diff(at[order], prepend=-1))
            sums[at[order][first]] += np.add.reduceat(z[order], first)
        parts = np.array_split(np.concatenate([slope, bend.ravel(), sums.ravel()]), SLICES)
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["slice", "sums"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, sums) to one row for each slice."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(raw, "f8")
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["slice", "sums"])


def _bins(taken: DataFrame, model: dict, fineness: int) -> np.ndarray:
    """(q, bin, n, total) in order of bin."""
    found = taken.mapInArrow(_counted(model, fineness), "q long, bin long, n long, total double").groupBy("q", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    return np.array(sorted((r.bin, r.q, r.n, r.total) for r in found.collect()))[:, [1, 0, 2, 3]]


def _newton(taken: DataFrame, model: dict, good: int, bad: int, fineness: int) -> np.ndarray:
    """The next weights: a Newton step of the mean loss of all good * bad pairs, with ridge.

    What a document meets in all of the other label is a smooth function of its worth, so it is summed over bins of their
    worths and interpolated. Curvature is that of coarse bins, which decides on the number of steps and not on where they end.
    """
    q, place, n, total = _bins(taken, model, fineness).T
    while np.ptp(place) > BINS:
        place, fineness = place // 2, fineness / 2
    sides = [(total[q == k] / n[q == k], n[q == k]) for k in (0, 1)]
    grid = np.arange(place.min(), place.max() + 2) / fineness
    lose = lambda t: 1 / (1 + np.exp(np.clip(t, -500, 500)))
    # A good worth loses against the bad ones above it, a bad one makes the good ones below it lose.
    slopes = np.array([lose(sides[1][0] - grid[:, None]) @ sides[1][1], lose(grid[:, None] - sides[0][0]) @ sides[0][1]])
    edges = np.linspace(grid[0], grid[-1], COARSE + 1)
    middle, edges = (edges[1:] + edges[:-1]) / 2, edges[1:-1]
    p = lose(middle[:, None] - middle)
    curve = p * (1 - p)
    held = [np.bincount(np.searchsorted(edges, c, "right"), m, COARSE) for c, m in sides]
    run = _sloped(model, grid, slopes, edges, np.array([curve @ held[1], curve @ held[0]]))
    rows = taken.mapInArrow(run, "slice int, sums binary").repartition("slice").mapInArrow(_added, "slice int, sums binary").collect()
    flat = np.concatenate([np.frombuffer(r.sums, "f8") for r in sorted(rows, key=lambda r: r.slice)])
    slope, bend, sums = np.split(flat, [WIDTH, WIDTH + WIDTH * WIDTH])
    lower, upper = sums.reshape(2, COARSE, WIDTH)
    cross = upper.T @ curve @ lower
    pairs = good * bad
    bend = (bend.reshape(WIDTH, WIDTH) - cross - cross.T) / pairs + RIDGE * np.eye(WIDTH)
    value, vector = np.linalg.eigh((bend + bend.T) / 2)
    return model["w"] - vector @ ((vector.T @ (slope / pairs + RIDGE * model["w"])) / np.maximum(value, RIDGE))


def fit(docs: DataFrame, labels: DataFrame, fineness: int = FINENESS) -> dict:
    """A model from all documents that `labels` (doc_id, quality 0 or 1) marks; labels of other values count for nothing.

    The weights minimise the loss of all pairs of a good and a bad document, and the cut is the exact quantile of all
    their worths. A document with labels that disagree is left out; of several texts under one id the one with the smallest
    features counts, so that every run takes the same. Null ids, null or other labels and labels of no document count for
    nothing; a null text is the empty one. Without documents or labels of both kinds all worths are 0.
    """
    marked = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("r")).filter("q = r").select("doc_id", F.col("q").cast("long"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id is not null")
    listed = rows.mapInArrow(_by_document(lambda x: pa.array([r.tobytes() for r in x.astype("<f4")], pa.binary()), "x"), "doc_id long, x binary")
    taken = settle(listed.join(marked, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x"), F.first("q").alias("q")).select("x", "q"), "taken")
    sums = sum((np.frombuffer(r.sums, "f8") for r in taken.mapInArrow(_moments, "sums binary").collect()), np.zeros(2 + 2 * WIDTH))
    bad, good = int(sums[0]), int(sums[1])
    count = max(1, good + bad)
    mean, square = sums[2:].reshape(2, WIDTH) / count
    spread = np.sqrt(np.maximum(0, square - mean * mean)) if good + bad else np.ones(WIDTH)
    spread = np.where(spread > 1e-6, spread, 1.0) / np.where(np.arange(WIDTH) < len(NAMES), 1.0, SHRUNK)
    model = {"w": np.zeros(WIDTH), "mean": mean, "spread": spread, "cut": 0.0 if good >= bad else 1.0}
    if not good or not bad:
        release(taken)
        return model
    for _ in range(STEPS):
        old, model["w"] = model["w"], _newton(taken, model, good, bad, fineness)
        if np.abs(model["w"] - old).max() < LEAST_STEP:
            break
    written = settle(taken.mapInArrow(_worth(model), "worth double"), "worths")
    # The worths on both sides of the quantile are in one bin, or in two with none between them.
    place = F.floor(F.col("worth") * fineness)
    bins, n = np.array(sorted((r.bin, r["count"]) for r in written.groupBy(place.alias("bin")).count().collect())).T
    ranks = [int(f(bad / count * (count - 1))) for f in (np.floor, np.ceil)]
    low, high = (int(bins[np.searchsorted(np.cumsum(n), k, "right")]) for k in ranks)
    near = written.filter(place.between(low, high)).groupBy("worth").count().collect()
    values, times = np.array(sorted((r.worth, r["count"]) for r in near)).T
    before = n[bins < low].sum()
    model["cut"] = float(np.mean([values[np.searchsorted(np.cumsum(times), k - before, "right")] for k in ranks]))
    release(written)
    release(taken)
    return model


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score for each row of `docs`: 0 to 1, higher for better.

    A null text is the empty one and is scored by its features like any other; null ids and repeated rows stay; an
    empty table stays empty; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_by_document(lambda x: pa.array(worths(x, model)), "score"), "doc_id long, score double")


def keep_good(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text scores `least` or more. Nothing is shuffled.

    Nulls, repeated rows and empty tables are treated as in score; column names don't matter but for text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [worths(features(texts), model) >= least for _, texts in together([0] * len(batch), batch.column("text"))]
            if marks:
                yield batch.filter(pa.array(np.concatenate(marks)))

    return docs.mapInArrow(run, docs.schema)
