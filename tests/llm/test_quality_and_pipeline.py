import collections
import os
import zlib

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from quillspark.llm.common import finish, settle, shared_dir
from quillspark.llm.jaccard_join import jaccard_components
from quillspark.llm.packing import pack
from quillspark.llm.quality import HASHED, WIDTH, bradley_terry, features, fit, keep_good, score, train, worths
from quillspark.llm.queries import QUERIES, SQL, op2_quality, op7_exact_dedup, tokenizer_path


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op2_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.97


def test_train_ranks_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, WIDTH))
    good = (x[:, 3] + 0.1 * rng.normal(size=400) > -0.5).astype(int)
    model = train(x, good, pairs=5000)
    assert ((worths(x, model) >= 0.5) == good).mean() > 0.9
    for only in (0, 1):
        assert ((worths(x, train(x, np.full(400, only))) >= 0.5) == only).all()


def test_weights_minimise_the_loss_of_all_pairs():
    """Against plain descent on every difference, laid out one by one."""
    rng = np.random.default_rng(5)
    z = rng.normal(size=(60, 6))
    better, worse = rng.integers(0, 30, 400), rng.integers(30, 60, 400)
    z[:30] += 0.4
    got = bradley_terry(z, better, worse, 0.01)
    d, w = z[better] - z[worse], np.zeros(6)
    for _ in range(20_000):
        w -= 0.2 * (0.01 * w - (d / (1 + np.exp(d @ w))[:, None]).mean(axis=0))
    assert np.allclose(got, w, atol=1e-5)


def test_cut_is_the_quantile_of_the_bad_share():
    rng = np.random.default_rng(6)
    x, good = rng.normal(size=(101, WIDTH)), np.arange(101) % 4 != 0
    model = train(x, good.astype(int), pairs=3000)
    worth = sorted((((x - model["mean"]) / model["spread"]).clip(-8, 8) @ model["w"]).tolist())
    at = (good == 0).sum() / 101 * 100
    assert np.isclose(model["cut"], (worth[int(np.floor(at))] + worth[int(np.ceil(at))]) / 2)


def test_hashed_features_are_shares_of_each_text():
    texts = [b"a b a", b"", b"xyz", "é à la".encode(), b"ab"]
    alone = np.vstack([features([t]) for t in texts])
    assert np.allclose(features(texts), alone)
    hashed = alone[:, -2 * HASHED :].reshape(5, 2, HASHED)
    assert np.allclose((hashed**2).sum(axis=2), [[1, 1], [0, 0], [1, 1], [1, 1], [1, 0]])


def test_fit_takes_the_same_text_of_a_repeated_id(spark):
    rows = [(i % 40, ("good words here and there " if i % 2 else "!!! ### $$$ ") * (1 + i % 7)) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1000 + i, 0) for i in range(100)] + [(None, 1), (3, 7)], "doc_id long, quality int")
    one, two = (fit(spark.createDataFrame(r, "doc_id long, text string").repartition(3), labels, 40) for r in (rows, rows[::-1]))
    assert np.allclose(one["w"], two["w"]) and one["w"].any()


def test_fit_takes_all_labelled_documents_and_all_pairs(spark):
    """Against every pair laid out; 64 of the 90 documents were taken when the third argument was a bound."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["good", "words", "here", "!!!", "###", "x1", "The", "of"], 30)) + (" ### !!!" if i % 3 == 0 and i % 2 else "")) for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)], "doc_id long, quality int")
    model = fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), labels, 64)
    x = features([t.encode() for _, t in rows])
    assert np.allclose(model["mean"], x.mean(axis=0))
    z = ((x - model["mean"]) / model["spread"]).clip(-8, 8)
    good = np.arange(90) % 3 > 0
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    want = bradley_terry(z, np.repeat(up, len(down)), np.tile(down, len(up)))
    assert np.abs(want).max() > 0.05 and np.abs(model["w"] - want).max() < 2e-3
    assert np.isclose(model["cut"], np.quantile(z @ model["w"], len(down) / 90, method="midpoint"))


def test_score_odd_rows(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    odd = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "x", 0), (2, "", 0), (3, "word " * 200_000, 0)], "doc_id long, text string, score int")
    got = score(odd, model).collect()
    assert len(got) == 5 and all(np.isfinite(r.score) for r in got)
    assert score(odd.limit(0), model).count() == 0 and keep_good(odd.limit(0), model).count() == 0
    assert keep_good(odd, model).columns == odd.columns
    none = fit(docs.limit(0), labels)
    assert all(0 <= r.score <= 1 for r in score(odd, none).collect())
    assert features([]).shape == (0, WIDTH)


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    steps = [settle(docs, "start")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        steps.append(settle(stage(spark, steps[-1], sf_dir), f"test{k}"))
    good, lines, near, packed = steps[1:]
    assert all(s.columns == docs.columns for s in (good, lines, near))
    kept = {r.doc_id for r in good.collect()}
    assert sum((i in kept) == (q == 1) for i, q in labels.items()) > 0.97 * len(labels)
    assert lines.count() == good.count() and lines.filter("n_chars <> length(text)").count() == 0
    names = {r.doc_id: r.component_id for r in jaccard_components(lines).collect()}
    assert {r.doc_id for r in near.collect()} == set(names.values())
    assert packed.select("doc_id").distinct().count() == near.count()
    want = pack(near, tokenizer_path("word_bpe_49k.json"))
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, want.collect()))


def test_pipeline_cleans_every_page_with_a_line_of_its_own(spark):
    notice = "a notice that is much longer than what thin pages say themselves"
    rows = [(i, f"{notice}\nown {i}", "en", f"s{i}", 0) for i in range(12)] + [(20 + i, notice, "en", f"s{i}", 0) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, df, "").collect()}
    assert got == {i: f"own {i}" for i in range(12)} | {20 + i: notice for i in range(12)}


def test_pipeline_judges_rows_that_share_an_id_by_their_text(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    rows = [(1, a), (1, a), (2, a + " more"), (3, b), (4, b + " tail"), (4, "a clean text of its own"), (5, None), (5, None), (None, b), (6, ""), (7, "x y z"), (7, "x y z")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.ngram_jaccard_join(spark, df, "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (3, b), (4, "a clean text of its own"), (5, None), (5, None), (6, ""), (7, "x y z")], key=str)


def boilerplate_left(docs):
    """Plain line dedup of (doc_id, text, source)."""
    sites = collections.defaultdict(set)
    for _, text, site in docs:
        for line in text.split("\n"):
            if line and site is not None:
                sites[line].add(site)
    out = {}
    for i, text, _ in docs:
        own = [x for x in text.split("\n") if len(sites[x]) < 10]
        out[i] = "\n".join(own) if any(own) else text
    return out


def near_copy_left(texts):
    """Plain join of {doc_id: text}: the smallest id of each component of near copies, and all ids without words."""
    sets = {}
    for i, text in texts.items():
        words = text.encode().lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}
    name = {i: i for i in sets}
    top = lambda i: i if name[i] == i else top(name[i])
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                name[high] = low
    return {i for i in sets if name[i] == i}


def test_pipeline_against_plain_python(spark, sf_dir):
    """What run() returns, worked out from the documents that the first stage keeps, stage by stage, and each piece of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = [(r.doc_id, r.text, r.source) for r in corpus_pipeline.quality_classifier(spark, docs, sf_dir).collect()]
    texts = boilerplate_left(good)
    kept = near_copy_left(texts)
    encoder = tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {i: [*encoder.encode(texts[i], add_special_tokens=False).ids, 2] for i in kept}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert len(ids) == r.length and r.doc_tokens == len(want[r.doc_id]) and zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        windows[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == kept
    for i, found in pieces.items():
        assert [a for a, _ in sorted(found)] == np.cumsum([0, *(n for _, n in sorted(found))])[:-1].tolist() and sum(n for _, n in found) == len(want[i])
    for found in windows.values():
        assert [a for a, _ in sorted(found)] == np.cumsum([0, *(n for _, n in sorted(found))])[:-1].tolist() and sum(n for _, n in found) <= 4096
    # Full but for the last windows: less than two half windows of padding in a corpus of one group.
    assert len(windows) <= sum(map(len, want.values())) / 4096 * 1.02 + 2


def test_pipeline_over_odd_tables(spark, tmp_path, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/none/labels.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    labels.write.parquet(f"{tmp_path}/odd/labels.parquet")
    some = docs.withColumns({c: F.lit(c) for c in ("_key", "best", "score", "rows", "n_lines", "a", "component_id", "sequence_id")})
    again = some.filter("doc_id < 40")
    nulls = some.limit(3).withColumns({"doc_id": F.col("doc_id") + 100_000, "text": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    odd = some.unionByName(again).unionByName(nulls).unionByName(some.filter("doc_id = 50").withColumn("doc_id", F.lit(None).cast("long")))
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    want, got = (corpus_pipeline.run(spark, d).select("doc_id", "start", "ids_crc32") for d in (sf_dir, f"{tmp_path}/odd"))
    # Repeated rows go as copies, and a copy without an id is never the one that stays; null texts are rejected or stay as end ids.
    end = zlib.crc32(np.array([2], "<u4").tobytes())
    plain = lambda df: {tuple(r) for r in df.collect() if r.ids_crc32 != end}
    assert plain(want) == plain(got)


def test_finish_leaves_nothing(spark, sf_dir):
    place = shared_dir(spark).removeprefix("file://")
    assert op7_exact_dedup(spark, sf_dir).count() and os.listdir(place)
    finish(spark)
    assert not os.path.exists(place) and shared_dir(spark) != f"file://{place}"


def test_a_cluster_needs_a_shared_folder():
    class Context:
        applicationId, master = "app-none", "spark://host:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_registry():
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in QUERIES)] == []
    assert set(SQL) <= set(QUERIES)
