import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm.exact_dedup import LISTED_BYTES, OWNED, Trie, _collapse, _own, exact_groups
from quillspark.llm.queries import op7_exact_dedup


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=40))
def test_trie_is_a_dictionary(keys):
    trie, known = Trie(), {}
    for i, k in enumerate(keys):
        trie.insert(k, i, i, 1)
        known.setdefault(k, []).append(i)
    assert {k: t[:3] for k, t in trie.subtrees()} == {k: [min(v), max(v), len(v)] for k, v in known.items()}


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").encode().lower(), []).append(i)
    return sorted((i, max(g), len(g), i == max(g), hashlib.sha256(k).hexdigest()) for k, g in groups.items() for i in g)


@pytest.mark.parametrize(("chunk_bytes", "list_rows"), [(24_000_000, 4096), (4000, 7), (1, 1)])
def test_against_brute_force(spark, chunk_bytes, list_rows):
    rng = random.Random(3)
    texts = ["", "A", "a", "É", "é", "ab", "abc", None, "long " * 20_000, *("word %d" % rng.randrange(30) for _ in range(300))]
    rows = [(i, rng.choice(texts)) for i in range(800)] + [(5000, "abc"), (5000, "abc"), (6000, "one"), (6000, "two")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, owner int, kept string").repartition(5)
    got = sorted(tuple(r) for r in exact_groups(df, chunk_bytes=chunk_bytes, list_rows=list_rows).collect())
    assert got == brute(rows)


def test_empty_and_null_ids(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    odd = spark.createDataFrame([(None, "a"), (1, "A")], "doc_id long, text string")
    assert [tuple(r)[:4] for r in exact_groups(odd, null_ids=False).collect()] == [(1, 1, 1, True)]
    assert sorted((tuple(r)[:4] for r in exact_groups(odd).collect()), key=str) == [(1, 1, 2, True), (None, 1, 2, None)]


def chunks(rows, chunk_bytes, list_rows):
    """What the first pass gives out, batch by batch."""
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([t for _, t in rows])], ["id", "text"])
    return [b.to_pylist() for b in _collapse(chunk_bytes, list_rows)(iter([batch]))]


def test_a_chunk_ends_by_its_members_too():
    """Many copies of one text: no list and no chunk grows without end, and no member is lost."""
    out = [r for rows in chunks([(i, "same") for i in range(50_000)], 100_000, 100) for r in rows]
    assert max(len(r["ids"]) for r in out) == 100 and sum(r["body"] is not None for r in out) >= 50_000 * LISTED_BYTES // 100_000
    assert sorted(i for r in out for i in r["ids"]) == list(range(50_000)) and sum(r["rows"] for r in out) == 50_000


def test_a_million_copies_in_one_partition(spark):
    df = spark.range(0, 1_000_000, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "Hot").otherwise("hot").alias("text"))
    row = exact_groups(df).agg(F.count("*"), F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.count_if("kept")).first()
    assert tuple(row) == (1_000_000, 999_999, 999_999, 1_000_000, 1)


def test_query_keeps_and_counts_null_ids(spark, tmp_path):
    rows = [(None, "a"), (1, "A"), (7, "a"), (None, "b"), (None, "B"), (2, "c")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r)[:4] for r in op7_exact_dedup(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(None, 7, 3, None), (1, 7, 3, False), (7, 7, 3, True), (None, None, 2, None), (None, None, 2, None), (2, 2, 1, True)], key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=5), min_size=1, max_size=40))
def test_the_heaviest_subtree_leaves_and_the_rest_stays(keys):
    """A subtree holds exactly the keys that begin as it does, and the trie goes on with the others."""
    trie = Trie()
    for i, k in enumerate(keys):
        trie.insert(k, i, i, 1)
    prefix, found = trie.heaviest(lambda t: 1)
    gone = {k for k, _ in found}
    assert gone == {k for k in keys if k.startswith(prefix)} and gone
    again = keys[0] + b"!"
    trie.insert(again, 7, 7, 1)
    assert {k for k, _ in trie.subtrees()} == (set(keys) - gone) | {again}


def own(rows, trie_bytes, merge_only=False):
    batch = pa.RecordBatch.from_pylist([{"owners": [o], "hash": hash(b) % 1000, "low": o, "high": o, "rows": 1, "n_bytes": len(b), "body": b} for o, b in rows], schema=OWNED)
    return [r for b in _own(trie_bytes, merge_only)(iter([batch])) for r in b.to_pylist()]


def test_a_trie_of_a_partition_holds_many_keys():
    rows = [(i, b"text %d" % (i % 40)) for i in range(200)]
    got = own(rows, 1 << 30)
    assert len(got) == 40 and all(r["body"] is None for r in got)
    assert sorted((sorted(r["owners"]), r["low"], r["high"], r["rows"]) for r in got) == sorted((list(range(k, 200, 40)), k, k + 160, 5) for k in range(40))


def test_one_subtree_is_spilt_and_the_rest_goes_on():
    """Texts that begin with "a" are the heavy ones: they leave with their bodies, and so does what follows of them."""
    rows = [(i, b"a%d " % (i % 20) * 40) for i in range(60)] + [(100 + i, b"b%d" % (i % 5)) for i in range(20)] + [(200 + i, b"a%d " % (i % 20) * 40) for i in range(20)]
    got = own(rows, 10_500)
    spilt, done = [r for r in got if r["body"] is not None], [r for r in got if r["body"] is None]
    assert {r["body"][:1] for r in spilt} == {b"a"} and done
    # What is done has met all of its rows, and no row is lost or done twice.
    assert sorted(o for r in got for o in r["owners"]) == sorted(o for o, _ in rows)
    b_rows = [r for r in done if r["n_bytes"] == 2]
    assert len(b_rows) == 5 and all(r["rows"] == 4 for r in b_rows)
    kept = {b for _, b in rows} - {r["body"] for r in spilt}
    assert len(done) == len(kept) and all(r["rows"] == sum(x == b for _, x in rows) for r in done for b in kept if len(b) == r["n_bytes"] and min(i for i, x in rows if x == b) == r["low"])


def test_small_tries_in_many_passes(spark):
    rng = random.Random(5)
    rows = [(i, "t%d " % rng.randrange(60) * rng.choice([1, 40])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = sorted(tuple(r) for r in exact_groups(df, chunk_bytes=3000, trie_bytes=9000).collect())
    assert got == brute(rows)


def test_one_text_in_a_thousand_chunks(spark):
    """Chunks of a few rows each: the hot text is merged in two steps, and what it stands beside is found too."""
    df = spark.range(0, 6000, 1, 4).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("hot text " * 20)).otherwise(F.concat(F.lit("other "), (F.col("id") % 30).cast("string"))).alias("text"))
    rows = [tuple(r) for r in df.collect()]
    assert sorted(tuple(r) for r in exact_groups(df, chunk_bytes=600, list_rows=4).collect()) == brute(rows)
