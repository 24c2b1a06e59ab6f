import collections
import pathlib
import random
import zlib
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillspark import stages
from quillspark.llm import jaccard_join
from quillspark.llm.embedding_dedup import bucket_keys, embedding_links, hadamard
from quillspark.llm.jaccard_join import ENTRY, PERCENT, SHINGLE, JaccardJoin, Order, Tuning, _cells, _crowded, _enter, _packed, _regions, jaccard_components
from quillspark.llm.wordhash import Words


def closed(ids, pairs):
    name = {i: i for i in ids}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            name[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(hadamard(x), axis=1) / 8, np.linalg.norm(x, axis=1))


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings(spark, block):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 48))
    rows = []
    for k, b in enumerate(base):
        for j in range(1 + (k % 5) * (12 if k == 4 else 1)):
            rows.append((len(rows), (b + rng.normal(size=48) * (0.25 if j else 0)).tolist(), k % 3))
    rows += [(len(rows) + j, base[0].tolist(), 0) for j in range(30)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 48, 0), (n + 2, [float("nan"), *base[0][1:]], 0), (n + 3, [None, *base[0][1:].tolist()], 0), (n + 4, base[0].tolist(), None), (n + 5, [float("inf")] * 48, 0), (n + 6, [], 0), (n + 7, [1e-160 * x for x in base[0]], 0), (n + 8, base[0][:20].tolist(), 0)]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], lab, "x") for i, v, lab in rows], "vec_id long, embedding array<double>, label int, n_links string")
    good = {i: np.array(v, float) / np.abs(np.array(v, float)).max() for i, v, lab in rows if v and None not in v and lab is not None and np.isfinite(v).all() and np.any(v)}
    lab = {i: x for i, _, x in rows}
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    pairs = [(a, b) for a in unit for b in unit if a < b and lab[a] == lab[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    links = collections.Counter(x for p in pairs for x in p)
    names = closed([r[0] for r in rows], pairs)
    got = {r.vec_id: r for r in embedding_links(df, block=block).collect()}
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got.values())
    assert found <= 2 * len(pairs) and found >= 0.97 * 2 * len(pairs)
    if found == 2 * len(pairs):
        assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], names[i], names[i] == i) for i in names}


def test_embeddings_bad_row_beside_a_good_one_of_its_id(spark):
    rows = [(1, [1.0, 0.0], 0), (1, None, 0), (1, [0.0, 0.0], 0), (1, [1.0, 0.0], None), (2, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (3, [float("nan"), 1.0], 0)]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted([(1, 1, 1), (2, 1, 1), (1, 0, 1), (1, 0, 1), (1, 0, 1), (None, 0, None), (3, 0, 3)], key=str)


def test_embeddings_repeated_ids(spark):
    """Two vectors under one id keep their own links, and each row of the table is a row of the result."""
    rows = [(5, [1.0, 0.0, 0.0], 0), (5, [0.0, 1.0, 0.0], 0), (6, [0.0, 1.0, 0.01], 0), (6, None, 0), (None, [1.0, 0.0, 0.0], 0), (7, [0.0, 1.0, 0.0], 0), (8, [1.0, 0.0, 0.0], 1)]
    got = embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted([(5, 0, 5, True), (5, 2, 5, True), (6, 2, 5, False), (6, 0, 6, True), (None, 0, None, None), (7, 2, 5, False), (8, 0, 8, True)], key=str)


@pytest.mark.parametrize(("width", "least"), [(64, 0.99), (256, 0.98), (768, 0.96)])
def test_pairs_at_the_threshold_share_a_bucket(width, least):
    rng = np.random.default_rng(width)
    x, y = rng.normal(size=(2, 1500, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (bucket_keys(v, np.zeros(1500, "i8")) for v in (x, y))
    assert (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean() >= least


def test_embeddings_empty(spark):
    assert embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def jaccard_brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    pairs = [(a, b) for k, (a, s) in enumerate(sets) for b, r in sets[:k] if s and r and 100 * len(s & r) >= 75 * len(s | r)]
    names = closed([i for i, _ in sets], pairs)
    return {i: (len(s), names[i]) for i, s in sets}


def near_copies(rng, n):
    words = [f"w{k}" for k in range(400)]
    rows = []
    passage = " ".join(rng.choice(words) for _ in range(60))
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.choice([1, 1, 1, 3, 8])):
            own = list(text)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own) + (" " + passage if rng.random() < 0.4 else ""))
    rows += ["", None, " \n\t", "A b C", "a B c", "a b", "x" * 50_000, "One two three four five", "one  two\nthree\tfour five", *(passage + f" tail{k}" for k in range(40))]
    rng.shuffle(rows)
    return list(enumerate(rows))


#: Tiny buckets, blocks and regions, common shingles dealt apart.
TINY = Tuning(crowd=(3, 6, 12), chunks=(1, 1, 3, 5), bucket_entries=200, pivots=3, leaf=4, block=5, part=3)


def jaccard_found(spark, rows, tuning):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n string, a int").repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, tuning=tuning).collect()}


@pytest.mark.parametrize(("seed", "tuning"), [(1, None), (2, TINY), (3, replace(TINY, depth=0)), (4, replace(TINY, radius=0.7)), (5, Tuning(chunks=(1, 3, 3, 5)))])
def test_jaccard(spark, seed, tuning):
    rows = near_copies(random.Random(seed), 40)
    assert jaccard_found(spark, rows, tuning) == jaccard_brute(rows)


def test_jaccard_dealt_shingle_with_few_sets(spark):
    """Copies make a shingle crowded whose sets are two; they meet though each is in a bucket of its own."""
    rng, rows = random.Random(4), []
    for _ in range(6):
        words = [f"w{rng.randrange(10_000)}" for _ in range(9)]
        rows += [" ".join(words[:8])] * 20 + [" ".join(words)]
    rows = list(enumerate(rows))
    assert jaccard_found(spark, rows, Tuning(chunks=(1, 64, 64, 64))) == jaccard_brute(rows)


def test_jaccard_shingle_of_more_copies_than_the_second_level(spark):
    """70,000 copies of one text, over several tasks, link with its start and its end: Jaccard is exactly 3/4."""
    rng = random.Random(9)
    words = [[f"w{rng.randrange(10_000)}" for _ in range(8)] for _ in range(3)]
    variants = [x for w in words for x in (w[:7], w[1:])]
    docs = spark.range(0, 70_000 * 3, 1, 6).select("id", F.element_at(F.array(*[F.lit(" ".join(w)) for w in words]), (F.col("id") % 3 + 1).cast("int")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(300_000 + k, " ".join(v)) for k, v in enumerate(variants)], "id long, text string"))
    found = jaccard_components(docs.withColumnRenamed("id", "doc_id"), tuning=Tuning(crowd=(16, 64, 4_194_304), chunks=(1, 1, 64, 64)))
    assert sorted((r.component_id, r["count"]) for r in found.groupBy("component_id").count().collect()) == [(0, 70_002), (1, 70_002), (2, 70_002)]


def cluster(rng, n, words, edits):
    """Texts that differ from one text in some words each: distances between them are all alike."""
    base = [f"b{k}" for k in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for j in range(rng.choice(edits)):
            own[rng.randrange(words)] = f"e{k}_{j}"
        out.append(" ".join(own))
    return out


def test_jaccard_dense_region_is_met_whole(spark):
    """A region that pivots don't part, with many components in it."""
    rows = list(enumerate(cluster(random.Random(3), 90, 60, [0, 1, 2, 3, 5, 6])))
    for tuning in (replace(TINY, depth=2), Tuning(leaf=20, block=16, part=32, pivots=4, depth=1)):
        assert jaccard_found(spark, rows, tuning) == jaccard_brute(rows)


def test_jaccard_cells_part_families(spark):
    """Families around a common passage: pivots part them, and windows carry the sets between two cells."""
    rng = random.Random(6)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = []
    for f in range(12):
        base = [f"f{f}_{k}" for k in range(60)]
        for k in range(10):
            own = list(base)
            for j in range(rng.choice([0, 1, 2, 4])):
                own[rng.randrange(60)] = f"x{f}_{k}_{j}"
            rows.append(passage + " " + " ".join(own))
    rows = list(enumerate(rows))
    # With no shingle known as crowded, windows hold the passage and all families are in one region.
    assert jaccard_found(spark, rows, Tuning(crowd=(10**9,), chunks=(1, 1), leaf=8, part=16, pivots=5)) == jaccard_brute(rows)


def test_cells_keep_every_link():
    """Any two sets that link meet: as pivot and set, or in a cell or the remainder, one of them at home there."""
    rng = np.random.default_rng(1)
    for _ in range(30):
        centres = [rng.integers(0, 2**63, 40, dtype="u8") for _ in range(3)]
        sets = []
        for k in range(60):
            own = centres[k % 3].copy()
            own[: rng.integers(0, 20)] = rng.integers(0, 2**63, 1, dtype="u8")
            sets.append(np.unique(own))
        home = rng.random(60) < 0.8
        pivots = np.flatnonzero(home)[:4].tolist()
        rows = [(1, 0, True, k, True, k, 60, sets[k].tobytes()) for k in pivots] + [(1, 0, False, k, bool(home[k]), k, 60, sets[k].tobytes()) for k in range(60)]
        names = ["region", "part", "pivot", "a", "home", "label", "members", "shingles"]
        out = [r for b in _cells(75, 0.4, 4)(iter([pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows])])) for r in b.to_pylist()]
        linked = {frozenset((p, r["a"])) for r in out for p in r["links"]}
        cells = {}
        for r in out:
            for cell, inside in [(r["cell"], True), *((k, False) for k in r["windows"])]:
                if cell is not None:
                    cells.setdefault(cell, {})[r["a"]] = inside
        for a in range(60):
            for b in range(a):
                same = len(np.intersect1d(sets[a], sets[b]))
                near = same >= 0.75 * (len(sets[a]) + len(sets[b]) - same)
                if not near:
                    assert frozenset((a, b)) not in linked
                elif (home[a] or home[b]) and frozenset((a, b)) not in linked:
                    assert any(a in c and b in c and (c[a] or c[b]) for c in cells.values()), (a, b)


def test_jaccard_odd_tables(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = jaccard_components(spark.createDataFrame([(3, "a b"), (3, "a b"), (5, "A b"), (None, "a b")], "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == [(3, 3), (3, 3), (5, 3), (None, None)]


def test_jaccard_writes_no_table_of_all_shingles(spark, monkeypatch):
    """Shingles that are counted are on disk once, in the shuffle; what is written is far less than the texts."""
    rng, written = random.Random(5), {}

    def settle(df, name, by=()):
        out = stages.settle(df, name, by)
        place = pathlib.Path(stages._PLACES[id(out)][1].removeprefix("file://"))
        written[name] = max(written.get(name, 0), sum(f.stat().st_size for f in place.rglob("*.parquet")))
        return out

    monkeypatch.setattr(jaccard_join, "settle", settle)
    rows = [(k, " ".join(f"w{rng.randrange(10_000)}" for _ in range(1000))) for k in range(400)]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(k, k) for k in range(400)]
    assert max(written.values()) < 0.2 * sum(len(t) for _, t in rows), written


def test_jaccard_shuffles_the_sets_of_its_pairs_only(spark, monkeypatch):
    given, beside = [], JaccardJoin.beside
    monkeypatch.setattr(JaccardJoin, "beside", lambda self, pairs, values, *rest: (given.append({r.a for r in values.select("a").collect()}), beside(self, pairs, values, *rest))[1])
    shingles = {a: np.arange(a // 2 * 10, a // 2 * 10 + 9 + a % 2, dtype="u8") for a in range(600)}
    sets = spark.createDataFrame([(a, len(v), bytearray(v.tobytes())) for a, v in shingles.items()], "a long, n long, value binary")
    docs = spark.createDataFrame([], "doc_id long, text string")
    join = JaccardJoin(docs, SHINGLE, PERCENT, "doc_id", "text", 0, Tuning())
    links = join.linked(spark.createDataFrame([(0, 1), (0, 2), (40, 41)], "p long, x long"), sets).collect()
    assert sorted((r.a, r.b) for r in links) == [(0, 1), (40, 41)]
    assert given[0] >= {0, 1, 2, 40, 41} and len(given[0]) < 30
    join.close()


def test_regions_leave_out_sets_of_far_sizes():
    """A set whose size is far from all others of a shingle's is in no region of it, unless the shingle is dealt."""
    rows = [(1, 10, 3), (1, 11, 4), (1, 12, 9), (2, 13, 1), (2, 14, 3), (3, 15, ~1), (3, 16, ~5), (4, 17, 2), (4, 18, 2), (4, 19, 4), (4, 20, 5)]
    entries = np.array(rows, ENTRY)
    batch = _packed(np.zeros(len(rows), "i8"), entries, ["bucket", "entries"])
    found = collections.defaultdict(set)
    for b in _regions(iter([batch])):
        for r in b.to_pylist():
            found[r["region"]].add((r["a"], r["band"]))
    assert sorted(sorted(v) for v in found.values()) == [[(10, 3), (11, 4)], [(15, 1), (16, 5)], [(17, 2), (18, 2), (19, 4), (20, 5)]]
    assert not list(_regions(iter([_packed(np.zeros(1, "i8"), entries[:1], ["bucket", "entries"])])))


def test_window_meets_every_partner():
    rng = random.Random(0)
    order = Order(7, [(b, k, np.random.default_rng(k + 7 * b).integers(0, 256, 512, dtype="u1").tobytes()) for b in range(6) for k in (1, 2)])
    for _ in range(200):
        n = rng.randrange(1, 60)
        x = np.array(sorted(rng.getrandbits(64) for _ in range(n)), "u8")
        y = set(x.tolist())
        while True:
            z = set(y)
            (z.discard if rng.random() < 0.5 else z.add)(rng.choice(list(y)) if rng.random() < 0.5 else rng.getrandbits(64))
            if not z or 100 * len(z & set(x.tolist())) < 75 * len(z | set(x.tolist())):
                break
            y = z
        y = np.array(sorted(y), "u8")
        chosen, _, owner = order.windows([x, y])
        assert set(chosen[owner == 0].tolist()) & set(chosen[owner == 1].tolist())


def crowded(sets, most, crowd=(2, 4)):
    """The filters of one bucket that holds all shingles of the sets."""
    packed = [(np.concatenate(sets) >> np.uint64(32)).astype("<u4").tobytes()]
    batches = [pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array(packed, pa.binary())], ["bucket", "marks"])]
    return [tuple(r.values()) for b in _crowded(crowd, most)(iter(batches)) for r in b.to_pylist()]


def test_filter_of_many_shingles_has_fewer_bits():
    """A level of more shingles than fit at full width keeps a filter, which rules some shingles out and never one of its own."""
    rng = np.random.default_rng(2)
    both, one = rng.integers(0, 2**63, 3000, dtype="u8"), rng.integers(0, 2**63, 3000, dtype="u8")
    filters = crowded([both, both, one], 12_000)
    assert [level for _, level, _ in filters] == [1] and 8 * len(filters[0][2]) == 12_000
    order = Order(1, iter(filters))
    assert (order.levels(both) == 1).all() and not order.alone(both, order.levels(both)).any()
    assert order.alone(one, order.levels(one)).mean() > 0.5


def test_shingles_of_one_set_are_not_entered():
    """They open no region, so nothing of them is shuffled; those of two sets are all there."""
    texts = [" ".join(f"{name}{k}" for k in range(40)) + " " + " ".join(f"both{k}" for k in range(20)) for name in "ab"]
    sets = Words([t.encode() for t in texts]).shingles(5)
    order = type("Sent", (), {"value": Order(1, crowded(sets, 1 << 20))})
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array(texts)], ["doc_id", "text"])
    def entered(single):
        out = _enter(5, 10, 0, order, (1, 1, 1), 1, single)(iter([batch]))
        return [s for b in out for raw in b.column(1).to_pylist() for s in np.frombuffer(raw, ENTRY)["s"].tolist()]

    common = set(np.intersect1d(*sets).tolist())
    some, every = entered(True), entered(False)
    assert len(some) < len(every) / 3 and sorted(s for s in some if s in common) == sorted(s for s in every if s in common)


def test_words_match_the_definition():
    texts = [b"", b" a\x0bB\x0c\r\nc ", "é\u00a0x Y".encode(), b"one two three four five six", b"ONE two three four five"]
    w = Words(texts)
    assert np.diff(w.first).tolist() == [len(t.split()) for t in texts]
    s = w.shingles(5)
    assert [len(x) for x in s] == [0, 1, 1, 2, 1] and set(s[4].tolist()) < set(s[3].tolist())
    assert zlib.crc32(b"") == 0
