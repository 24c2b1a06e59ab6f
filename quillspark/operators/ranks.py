"""Places and values by rank, over one fixed partitioning by ranges.

Rows are dealt to ranges of an order and written once with the number of their range. How many rows each range holds is
all that has to be known beyond it: a row's place is that of its range and its place inside, and a value by rank is
looked for in the one range that holds the rank. No task holds more than a range, whatever the size of a group.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.stages import release, same, settle

RANGE = "_range"


class Ranking:
    """The rows of a table in a total order, numbered from 1. Rows that tie in all of `order` are numbered in any order."""

    def __init__(self, df: DataFrame, *order: Column | str) -> None:
        self.order = order
        # Bounds are sampled and rows dealt in this one job; all that follows reads what it has written.
        self.held = settle(df.repartitionByRange(*order).withColumn(RANGE, F.spark_partition_id()), "ranges", [RANGE])
        # A row for each range.
        sizes = sorted((r[RANGE], r.n) for r in self.held.groupBy(RANGE).agg(F.count("*").alias("n")).collect())
        self.starts: list[tuple[int, int, int]] = []
        self.total = 0
        for part, n in sizes:
            self.starts.append((part, self.total, n))
            self.total += n

    def rows(self, name: str = "rank") -> DataFrame:
        """All rows with their place."""
        return self._placed(self.held, self.starts, name)

    def between(self, first: int, last: int, name: str = "rank") -> DataFrame:
        """The rows of places `first` to `last`: only the ranges that hold some of them are read."""
        hit = [x for x in self.starts if x[1] < last and x[1] + x[2] >= first]
        return self._placed(self.held.filter(F.col(RANGE).isin([x[0] for x in hit])), hit, name).filter(F.col(name).between(first, last))

    def page(self, number: int, size: int) -> DataFrame:
        """Page `number` from 1, in order; a number past the end is the last page, one below 1 the first."""
        first = (min(max(1, number), max(1, -(-self.total // size))) - 1) * size
        return self.between(first + 1, first + size, "_rank").orderBy("_rank").drop("_rank")

    def release(self) -> None:
        release(self.held)

    def _placed(self, rows: DataFrame, starts: list[tuple[int, int, int]], name: str) -> DataFrame:
        spark = rows.sparkSession
        # A row for each range: a table of fixed size, as there are as many ranges as shuffle partitions.
        before = F.broadcast(spark.createDataFrame([(a, b) for a, b, _ in starts], f"{RANGE} int, _before long"))
        inside = F.row_number().over(W.partitionBy(RANGE).orderBy(*self.order))
        return rows.withColumn("_inside", inside).join(before, RANGE).withColumn(name, F.col("_inside") + F.col("_before")).drop(RANGE, "_inside", "_before")


class RankedCounts:
    """Distinct values of groups in order, with how often each occurs, to be asked for the value at a rank.

    counted: `group` columns, `value`, n. Nulls among the group's columns are values of their own.
    """

    def __init__(self, counted: DataFrame, group: list[str], value: str = "value") -> None:
        self.group, self.value = group, value
        self.held = settle(counted.select(*group, value, "n").repartitionByRange(*group, value).withColumn(RANGE, F.spark_partition_id()), "counts")
        # For each group a row for each of its ranges.
        self.parts = settle(self.held.groupBy(*group, RANGE).agg(F.sum("n").alias("held")), "parts")

    def totals(self) -> DataFrame:
        """group, n: how many values each group has, repeated ones counted."""
        return self.parts.groupBy(*self.group).agg(F.sum("held").alias("n"))

    def at(self, asked: DataFrame, rank: str = "rank", out: str = "value") -> DataFrame:
        """`asked` (group, rank from 0, other columns) with the value at that rank of its group, by sorted merges.

        The ranges of a group, then the values of a range, are merged with the ranks that are asked for: the last one that
        begins at a rank or before it holds it. Ranks past the end get the last value.
        """
        columns = asked.columns
        before = F.coalesce(F.sum("held").over(W.partitionBy(*self.group).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        starts = self.parts.select(*self.group, RANGE, before.alias("_start"))
        placed = _merged(asked, starts, self.group, rank, "_start", {RANGE: RANGE, "_start": "_from"}, columns)
        needed = placed.select(*self.group, RANGE).distinct()
        own = [*self.group, RANGE]
        rows = self.held.join(needed, same(self.held, needed, own), "left_semi")
        inside = F.sum("n").over(W.partitionBy(*own).orderBy(self.value).rowsBetween(W.unboundedPreceding, -1))
        rows = rows.select(*own, self.value, F.coalesce(inside, F.lit(0)).alias("_start"))
        local = placed.withColumn("_local", F.col(rank) - F.col("_from"))
        return _merged(local, rows, own, "_local", "_start", {self.value: out}, columns)

    def release(self) -> None:
        release(self.held, self.parts)


def _merged(asked: DataFrame, starts: DataFrame, group: list[str], rank: str, start: str, taken: dict[str, str], columns: list[str]) -> DataFrame:
    """`columns` and `group` of `asked`, and under new names the columns `taken` of the last of `starts` not above its rank."""
    rest = [c for c in {**dict.fromkeys(columns), **dict.fromkeys(asked.columns)} if c not in group]
    # Starts come before ranks that are equal to them.
    left = starts.select(*group, F.col(start).cast("long").alias("_at"), F.lit(0).alias("_kind"), F.struct(*[F.col(a).alias(b) for a, b in taken.items()]).alias("_taken"), F.lit(None).cast(asked.select(F.struct(*rest)).schema[0].dataType).alias("_row"))
    right = asked.select(*group, F.col(rank).cast("long").alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(left.schema["_taken"].dataType).alias("_taken"), F.struct(*rest).alias("_row"))
    order = W.partitionBy(*group).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    met = left.unionByName(right).withColumn("_taken", F.last("_taken", ignorenulls=True).over(order)).filter("_kind = 1")
    return met.select(*group, "_row.*", "_taken.*")


@dataclass(frozen=True)
class Quantile:
    """A linearly interpolated quantile of the values that aren't null, as a column of a summary."""

    column: Column
    q: float
    digits: int
    name: str = ""

    def alias(self, name: str) -> Quantile:
        return Quantile(self.column, self.q, self.digits, name)


def quantile(c: Column | str, q: float, digits: int = 4) -> Quantile:
    return Quantile(F.col(c) if isinstance(c, str) else c, q, digits)


def summarise(df: DataFrame, keys: list[str], *measures: Column | Quantile) -> DataFrame:
    """`df` by `keys` with its measures in this order; quantiles are exact and come from ranks over counted values.

    Values are counted by group before they move, so a value that very many rows share is one row. No task holds a
    group's values. A group without a value has null quantiles; a null key is a group of its own.
    """
    wanted = [m for m in measures if isinstance(m, Quantile)]
    plain = [m for m in measures if not isinstance(m, Quantile)]
    base = df.groupBy(*keys).agg(*plain) if plain else df.select(*keys).distinct()
    if not wanted:
        return base
    group = [*keys, "_metric"]
    metrics: dict[str, tuple[int, Column]] = {}
    for m in wanted:
        metrics.setdefault(str(m.column), (len(metrics), m.column))
    # Adding 0 makes the negative zero the positive one.
    values = F.array(*[F.struct(F.lit(k).alias("_metric"), (c.cast("double") + F.lit(0.0)).alias("_value")) for k, c in metrics.values()])
    long = df.select(*keys, F.inline(values)).filter("_value is not null")
    ranked = RankedCounts(long.groupBy(*group, "_value").agg(F.count("*").alias("n")), group, "_value")
    marks = F.array(*[F.struct(F.lit(metrics[str(m.column)][0]).alias("_of"), F.lit(k).alias("_mark"), F.lit(float(m.q)).alias("_q")) for k, m in enumerate(wanted)])
    asked = ranked.totals().select("*", F.inline(marks)).filter("_of = _metric").withColumn("_place", (F.col("n") - 1) * F.col("_q"))
    low = F.floor("_place").cast("long")
    asked = asked.select(*group, "_mark", (F.col("_place") - low).alias("_part"), F.explode(F.array_distinct(F.array(low, F.ceil("_place").cast("long")))).alias("rank"))
    met = ranked.at(asked, out="_value")
    ends = met.groupBy(*keys, "_mark").agg(F.max("_part").alias("_part"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    between = (1 - F.col("_part")) * F.col("_low") + F.col("_part") * F.col("_high")
    exact = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(between)
    wide = ends.withColumn("_exact", exact).groupBy(*keys).agg(*[F.round(F.max(F.when(F.col("_mark") == k, F.col("_exact"))), m.digits).alias(m.name) for k, m in enumerate(wanted)])
    if not keys:
        return base.join(F.broadcast(wide))  # one row each
    named = wide.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(keys)})
    on = reduce(lambda a, b: a & b, [base[k].eqNullSafe(named[f"_k{n}"]) for n, k in enumerate(keys)])
    out = base.join(named, on, "left").drop(*[f"_k{n}" for n in range(len(keys))])
    order = [m.name if isinstance(m, Quantile) else None for m in measures]
    rest = iter(base.columns[len(keys) :])
    return out.select(*keys, *[n if n is not None else next(rest) for n in order])
