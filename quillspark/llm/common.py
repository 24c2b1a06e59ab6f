"""What the operators of this subpackage share: written stages, skew-safe lookups, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.stages import finish, release, settle, shared_dir

__all__ = ["ascii_lower", "connected_components", "finish", "lookup", "release", "settle", "shared_dir", "table", "unused"]


def unused(name: str, columns: list[str]) -> str:
    """`name`, lengthened until no column of a table is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: A key with more than this share of all rows is hot, so fewer than 1 / HOT_SHARE hot keys exist, whatever the input.
HOT_SHARE = 0.001


def lookup(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, by: Column) -> DataFrame:
    """Left join to `right`, which has one row for each `key` and in `weight` how many rows of `left` have it.

    Hot keys are dealt on the left, by `by`, to as many parts as they hold shares, and repeated on the right for each,
    so no task gets all rows of one key. The broadcast side holds hot keys only: fewer than 1 / HOT_SHARE rows.
    """
    taken = [*left.columns, *right.columns]
    hot_key, parts, salt, own = (unused(n, taken) for n in ("hot_key", "parts", "salt", "own_key"))
    share = F.lit(max(1.0, total * HOT_SHARE))
    many = F.ceil(F.col(weight) / share).cast("int")
    hot = right.filter(F.col(weight) > share).select(F.col(key).alias(hot_key), many.alias(parts))
    marked = left.join(F.broadcast(hot), left[key].eqNullSafe(F.col(hot_key)), "left")
    marked = marked.withColumn(salt, F.when(F.col(parts).isNotNull(), F.pmod(F.xxhash64(by, F.lit("salt")), F.col(parts))).otherwise(F.lit(0)).cast("int")).drop(hot_key, parts)
    salts = F.when(F.col(weight) > share, F.sequence(F.lit(0), many - 1)).otherwise(F.array(F.lit(0)))
    spread = right.withColumn(salt, F.explode(salts)).withColumnRenamed(key, own)
    joined = marked.join(spread, marked[key].eqNullSafe(spread[own]) & (marked[salt] == spread[salt]), "left")
    return joined.drop(marked[salt]).drop(spread[salt]).drop(own)


#: Links of a task that turns its links into a forest, on average, and the nodes that it holds at most.
FOREST_LINKS, FOREST_NODES = 20_000, 100_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) to stars: every node of a task's links with the smallest that it reaches through them, in both directions."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def stars() -> pa.RecordBatch:
        found = [(x, r) for x in list(parent) if (r := top(x)) != x]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([k[side] for k in found] + [k[1 - side] for k in found], pa.int64()) for side in (0, 1)], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
        if len(parent) > FOREST_NODES:
            yield stars()
    if parent:
        yield stars()


def connected_components(edges: DataFrame, max_rounds: int = 60, task_links: int = FOREST_LINKS) -> DataFrame:
    """(node, component) for each node of the links (a, b); component is the smallest node that can be reached.

    Each task first turns its links, about `task_links` of them, into stars, so that paths are short; links that are one
    task's work are done by that. Else minimum labels travel along the stars of all tasks, and each label jumps to its own
    label; every round is written out. A hub of many links, or a label of many nodes, is dealt to several tasks.
    """
    linked = settle(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b"), "edges")
    tasks = 1 + linked.count() // max(1, task_links)
    both = settle(linked.coalesce(tasks).mapInArrow(_forest, "a long, b long"), "links")
    release(linked)
    count = both.count()
    if tasks == 1 and count < FOREST_NODES:
        stars = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        return stars.select("node", F.least("node", "m").alias("component"))
    start = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("links"))
    labels = settle(start.select("node", F.least("node", "m").alias("component"), "links"), "labels")
    nodes = labels.count()
    for _ in range(max_rounds):
        named = lookup(both, labels.select(F.col("node").alias("b"), F.col("component").alias("c"), "links"), "b", "links", count, F.col("a"))
        best = named.groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        step = settle(labels.join(best, "node").select("node", "links", F.least("component", "c").alias("next"), F.col("component").alias("old")), "step")
        jump = step.groupBy("next").agg(F.count("*").alias("times")).join(labels.select(F.col("node").alias("next"), F.col("component").alias("far")), "next")
        moved = lookup(step, jump, "next", "times", nodes, F.col("node"))
        new = settle(moved.select("node", F.least("next", F.coalesce("far", "next")).alias("component"), "links", "old"), "labels")
        release(labels, step)
        labels = new
        if not new.filter("component <> old").limit(1).count():
            release(both)
            return new.select("node", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
