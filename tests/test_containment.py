"""Names inside texts by automaton, against every pair."""

import random

from pyspark.sql import functions as F

from quillspark.operators.containment import held_and_holding


def by_hand(own, others):
    out = {}
    for g, t in own:
        fits = [(low, high) for h, o, low, high in others if h == g and (o in t or t in o)]
        if fits:
            out[g, t] = (min(x[0] for x in fits), max(x[1] for x in fits))
    return out


def test_every_containment_is_found(spark):
    """Names of one to nine letters, in several blocks and spans, with a group that one side lacks and null groups."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("AB7é😀") for _ in range(rng.randint(1, 9)))
    own = sorted({(g, word()) for g in ("x", "y", "z") for _ in range(120)})
    others = [(g, t, k, k + rng.randrange(3)) for k, (g, t) in enumerate(sorted({(g, word()) for g in ("x", "y", "w") for _ in range(90)}))]
    a = spark.createDataFrame([*own, (None, "AB")], "grp string, text string")
    b = spark.createDataFrame([*others, (None, "A", 1, 1)], "grp string, text string, low int, high int")
    for block, span in ((50_000, 200_000), (13, 17), (1, 1000)):
        got = {(r.grp, r.text): (r.low, r.high) for r in held_and_holding(a, b, block, span).collect()}
        assert got == by_hand(own, others)
    assert held_and_holding(a.limit(0), b).count() == held_and_holding(a, b.limit(0)).count() == 0


def test_no_row_for_each_pair(spark):
    """A name that all texts hold is one row, however many they are."""
    a = spark.range(3000).select(F.lit("g").alias("grp"), F.concat(F.lit("P"), F.col("id").cast("string")).alias("text"))
    b = spark.createDataFrame([("g", "P", 5, 9)], "grp string, text string, low int, high int")
    assert held_and_holding(a, b).select("low", "high").distinct().collect()[0][:] == (5, 9)
    got = held_and_holding(b.select("grp", "text"), a.withColumns({"low": F.length("text"), "high": F.length("text")})).collect()
    assert [tuple(r) for r in got] == [("g", "P", 2, 5)]
