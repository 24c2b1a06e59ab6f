"""Positions and running sums over the turns of conversations, however long one of them is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import release, settle

#: Running sums are taken inside of segments of so many positions; what stands before a segment is added to them.
SEGMENT = 1024
#: Turn hashes have 36 bits in each of three lanes, so the sum of 2**27 of them still fits 64 bits.
LANE, LANES = 1 << 36, ("a", "b", "c")


def positions(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """`rows` with pos, from 1 within each `key` in `order`; rows that agree in all of it are in any order.

    The rows are dealt by ranges of (key, order) and written once, with the number of their range. Ranks inside of a range
    and the rows of earlier ranges make up a position, so no task holds a key that is larger than a range.
    """
    tie = F.monotonically_increasing_id()
    spread = settle(rows.withColumn("_tie", tie).repartitionByRange(key, *order, "_tie").withColumn("_range", F.spark_partition_id()), "ranges")
    # A row for each key and range: as many as there are keys, and a few for each range.
    counts = spread.groupBy(key, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(key).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select(key, "_range", F.coalesce(before, F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(key, "_range").orderBy(*order, "_tie"))
    placed = spread.withColumn("_inside", inside).join(starts.hint("merge"), [key, "_range"])
    out = settle(placed.withColumn("pos", F.col("_inside") + F.col("_start")).drop("_inside", "_start", "_range", "_tie"), "placed")
    release(spread)
    return out


def segment(pos: Column) -> Column:
    return F.floor((pos - 1) / SEGMENT).cast("long")


def running_sums(rows: DataFrame, key: str, pos: str, sums: list[str], upwards: bool = True) -> DataFrame:
    """`rows` with each of `sums` replaced by its running sum by `pos` within `key`; downwards: from the last position on.

    Sums are taken inside of segments of positions; the sums of whole segments carry over, so one endless key is dealt to
    many tasks.
    """
    cut = rows.withColumn("_segment", segment(F.col(pos)))
    by = (lambda c: F.col(c)) if upwards else F.desc
    totals = cut.groupBy(key, "_segment").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    before = W.partitionBy(key).orderBy(by("_segment")).rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select(key, "_segment", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in sums])
    inside = W.partitionBy(key, "_segment").orderBy(by(pos)).rowsBetween(W.unboundedPreceding, 0)
    run = cut.withColumns({c: F.sum(c).over(inside) for c in sums}).join(carried.hint("merge"), [key, "_segment"])
    return run.withColumns({c: F.col(c) + F.col(f"_{c}") for c in sums}).drop("_segment", *[f"_{c}" for c in sums])


def turn_lanes(pos: str, *parts: str) -> dict[str, Column]:
    """The lanes of a turn's hash, which its position is part of: the sum over a prefix stands for the prefix."""
    return {c: F.pmod(F.xxhash64(F.lit(c), F.col(pos).cast("long"), *parts), F.lit(LANE)) for c in LANES}
