"""Top k, pages, samples and custom orders. Every order is total: ties go to the record's id."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.ranks import Ranking, quantile, summarise
from quillspark.schema import TEMPLATES


def top_by(df: DataFrame, value: str, k: int, tie: str = "note_id") -> DataFrame:
    return df.orderBy(F.desc_nulls_last(value), tie).limit(k)


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with rank: its place, from 1, in a total order."""
    return Ranking(df, *order).rows()


def page(df: DataFrame, number: int, size: int, *order: Column) -> DataFrame:
    """Page `number` from 1; a number past the end is the last page. For more pages of one order keep a Ranking."""
    return Ranking(df, *order).page(number, size)


def template_order(c: Column) -> Column:
    """The reports' order of templates, others after them."""
    return F.coalesce(*[F.when(c == t, F.lit(k)) for k, t in enumerate(TEMPLATES)], F.lit(len(TEMPLATES)))


def hashed_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """`n` rows without replacement, the same ones on every run: the first in order of the MD5 of seed and key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)


def drawn_positions(size: int, n: int, seed: int) -> list[int]:
    """Places from 0, in rising order, of a sample without replacement of `n` of `size` things by the seeded generator.

    What the generator draws depends on the two numbers only, so no pool has to be gathered for it.
    """
    if n <= 0:
        raise ValueError("a sample has one row at least")
    if n > size:
        raise ValueError(f"{n} rows were asked for and {size} are there")
    return sorted(random.Random(seed).sample(range(size), n))


#: Places that one sample may draw: they are sent to the tasks that look for their rows.
MOST_DRAWN = 1_000_000


def seeded_sample(df: DataFrame, n: int, seed: int, *order: Column | str, method: str = "random") -> DataFrame:
    """`n` rows of `df` in a total order: those that the seeded generator draws from the ordered rows, or the first ones.

    Asking for none, or for more than there are, is an error.
    """
    held = Ranking(df, *order)
    if method != "random":
        drawn_positions(held.total, n, seed)
        return held.page(1, n)
    if n > MOST_DRAWN:
        raise ValueError(f"a sample has {MOST_DRAWN} rows at most")
    places = df.sparkSession.createDataFrame([(k + 1,) for k in drawn_positions(held.total, n, seed)], "_place long")
    # MOST_DRAWN numbers at most.
    return held.rows("_rank").join(F.broadcast(places), F.col("_rank") == F.col("_place")).orderBy("_rank").drop("_rank", "_place")


def systematic(df: DataFrame, points: int, value: str, clip: float, *order: Column) -> DataFrame:
    """Every ceil(rows / points)-th row in order, with `value` held to its `clip` quantile over all rows."""
    row = summarise(df, [], F.count("*").alias("n"), quantile(value, clip, 9).alias("q")).first()
    step = max(1, -(-row.n // points))
    return ranked(df, *order).filter((F.col("rank") - 1) % step == 0).withColumn("clipped", F.round(F.least(F.col(value), F.lit(row.q)), 4)).drop("rank")


def record_order(name: str) -> list[Column]:
    """The five orders of the record list."""
    return {
        "newest": [F.desc_nulls_last("validation_date"), F.col("note_id")],
        "oldest": [F.asc_nulls_last("validation_date"), F.col("note_id")],
        "longest": [F.desc_nulls_last("words"), F.col("note_id")],
        "shortest": [F.asc_nulls_last("words"), F.col("note_id")],
        "template": [template_order(F.col("template")), F.col("template"), F.col("note_id")],
    }[name]
