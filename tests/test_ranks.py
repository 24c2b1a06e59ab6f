"""Places, quantiles and tests that rest on ranks over one fixed partitioning."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.operators import inference as I
from quillspark.operators import ordering as O
from quillspark.operators.ranks import RankedCounts, Ranking, quantile, summarise
from quillspark.stages import settle


@pytest.fixture(scope="module")
def wide(spark):
    """400,000 rows in a mixed order, with columns that a count of ranges doesn't need."""
    k = F.col("id") * 7919 % 400009
    return settle(spark.range(400_000).select(k.alias("k"), F.xxhash64("id").alias("payload"), F.rand(5).alias("v"), (F.col("id") % 3).alias("g")), "wide")


def test_every_rank_is_right(wide):
    got = O.ranked(wide, F.desc("k"))
    want = wide.select("payload", F.row_number().over(W.orderBy(F.desc("k"))).alias("place"))
    assert got.select(F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()[:] == (400_000, 1, 400_000)
    assert got.join(want, "payload").filter("rank <> place").count() == 0


def test_pages_read_their_ranges_only(wide, spark):
    held = Ranking(wide, "k")
    order = [r.k for r in wide.orderBy("k").select("k").collect()]
    for number in (1, 7, 5000, 10_000):
        assert [r.k for r in held.page(number, 40).collect()] == order[(number - 1) * 40 : number * 40]
    assert [r.k for r in held.page(99_999, 40).collect()] == order[-40:] and [r.k for r in held.page(-3, 40).collect()] == order[:40]
    hit = [x for x in held.starts if x[1] < 280 and x[1] + x[2] >= 241]
    assert len(hit) < len(held.starts)
    assert re.search(r"PartitionFilters: \[[^\]]*_range", held.page(7, 40)._jdf.queryExecution().executedPlan().toString())
    empty = Ranking(wide.limit(0), "k")
    assert empty.total == 0 and empty.page(1, 10).count() == 0


def test_quantiles_of_a_group_with_a_million_values(spark):
    """A group of 10**6 distinct values beside small ones, a null key, nulls, negative zeros and a group without values."""
    big = spark.range(1_000_000).select(F.lit("big").alias("t"), (F.col("id") * 3 % 1_000_003).cast("double").alias("v"))
    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), (None, -0.0), (None, 0.0), ("none", None), ("one", 7.5), ("tie", 3.0), ("tie", 3.0), ("a", None)]
    df = big.union(spark.createDataFrame(rows, "t string, v double"))
    got = {r.t: r[1:] for r in summarise(df, ["t"], quantile("v", 0.25).alias("q25"), F.count("v").alias("n"), quantile("v", 0.5).alias("q50"), quantile("v", 0.9).alias("q90")).collect()}
    values = np.arange(1_000_000) * 3 % 1_000_003
    want = [round(float(np.quantile(values, q)), 4) for q in (0.25, 0.5, 0.9)]
    assert got["big"] == (want[0], 1_000_000, *want[1:])
    assert got["a"] == (1.5, 3, 2.0, 3.6) and got[None] == (0.0, 2, 0.0, 0.0) and got["none"] == (None, 0, None, None) and got["one"] == (7.5, 1, 7.5, 7.5) and got["tie"] == (3.0, 2, 3.0, 3.0)
    assert str(got[None][0]) == "0.0"


def test_no_task_holds_the_values_of_a_group(spark, wide):
    """With ranges as they are for much data: small ones are otherwise put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _ranges_share_a_group(wide)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _ranges_share_a_group(wide):
    counts = RankedCounts(wide.groupBy("g", F.col("v").alias("value")).agg(F.count("*").alias("n")), ["g"])
    most = counts.parts.agg(F.max("held")).first()[0]
    assert most < 0.8 * counts.totals().agg(F.max("n")).first()[0]
    assert counts.parts.groupBy("g").count().agg(F.max("count")).first()[0] > 1


def test_quantiles_without_keys_and_without_rows(spark, wide):
    one = summarise(wide, [], F.count("*").alias("n"), quantile("k", 0.5).alias("m"))
    assert one.first()[:] == (400_000, round(float(np.median(np.arange(400_000) * 7919 % 400_009)), 4))
    assert summarise(wide.limit(0), [], F.count("*").alias("n"), quantile("k", 0.5).alias("m")).first()[:] == (0, None)
    assert summarise(wide.limit(0), ["g"], quantile("k", 0.5).alias("m")).count() == 0


def test_random_quantiles_match_numpy(spark):
    rng = random.Random(4)
    rows = [(k % 7, float(rng.choice([rng.gauss(0, 1e6), rng.randrange(5), -1.5]))) for k in range(4000)]
    qs = [0.0, 0.01, 0.33, 0.5, 0.98, 1.0]
    got = summarise(spark.createDataFrame(rows, "g int, v double"), ["g"], *[quantile("v", q, 6).alias(f"q{k}") for k, q in enumerate(qs)]).collect()
    for r in got:
        assert list(r[1:]) == pytest.approx([np.quantile([v for g, v in rows if g == r.g], q) for q in qs], abs=2e-6)


def test_ranks_past_the_end_and_in_ranges(spark):
    counted = spark.createDataFrame([("x", 10.0, 2), ("x", 20.0, 1), (None, 5.0, 3)], "g string, value double, n long")
    asked = spark.createDataFrame([("x", 0, "a"), ("x", 1, "b"), ("x", 2, "c"), ("x", 9, "d"), (None, 2, "e")], "g string, rank long, name string")
    got = {r.name: r.value for r in RankedCounts(counted, ["g"]).at(asked).collect()}
    assert got == {"a": 10.0, "b": 10.0, "c": 20.0, "d": 20.0, "e": 5.0}


def test_resampling_by_rank_equals_the_histogram(spark):
    """What the ranks answer is what the functions over one whole histogram give."""
    rng = random.Random(9)
    rows = [(t, y, rng.choice([rng.gauss(m, 3), float(rng.randrange(9))]), rng.random()) for t, m in (("A", 2), (None, 5), ("B", 4)) for y in (1, 2) for _ in range(rng.randrange(30, 60))] + [("few", 1, 1.0, 2.0), ("few", 2, 3.0, None)]
    df = spark.createDataFrame(rows, "template string, year int, words double, ratio double")
    got = {(r.template, r.metric): r for r in I.year_tests(df, ["words", "ratio"], 1, 2, reps=400).collect()}
    assert set(got) == {(t, m) for t in ("A", None, "B", "few") for m in ("words", "ratio")}
    for (t, m), r in got.items():
        side = lambda y: [x for x in (row[2 if m == "words" else 3] for row in rows if row[0] == t and row[1] == y) if x is not None]
        values = np.array(sorted({*side(1), *side(2)}))
        counts = [np.array([side(y).count(v) for v in values]) for y in (1, 2)]
        assert (r.n_before, r.n_after) == (len(side(1)), len(side(2)))
        if t == "few":
            assert r.p is None and r.ci_low is None and r.difference is None
            continue
        assert (r.ci_low, r.ci_high) == I.bootstrap_interval(values, *counts, reps=400) and r.p == I.permutation_p(values, *counts, reps=400)
        assert r.difference == np.median(side(2)) - np.median(side(1))
