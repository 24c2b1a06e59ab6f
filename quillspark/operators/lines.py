"""Lines of documents: order, segments, markers, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def explode_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, ord, line) with ord from 0."""
    return docs.select(doc, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("ord", "line"))


def visible_lines(words: DataFrame) -> DataFrame:
    """Words (doc_id, page_no, block, line, x0, y0, x1, y1, word) to lines in reading order."""
    parts = F.array_sort(F.collect_list(F.struct("x0", "y0", "word")))
    lines = words.groupBy("doc_id", "page_no", "block", "line").agg(
        F.array_join(F.transform(parts, lambda w: w["word"]), " ").alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"),
    )
    return lines.withColumn("ord", F.row_number().over(W.partitionBy("doc_id").orderBy("page_no", "y0", "x0", "block", "line")))


def top_right(lines: DataFrame, x_from: float = 0.55, y_until: float = 0.40) -> DataFrame:
    """Lines of the first page that end right of `x_from` of its width and begin above `y_until` of its height; runs of the same text once."""
    inside = lines.filter((F.col("page_no") == 1) & (F.col("x1") >= x_from * F.col("page_w")) & (F.col("y0") <= y_until * F.col("page_h")))
    order = W.partitionBy("doc_id").orderBy("y0", "x0")
    return inside.withColumn("_before", F.lag("text").over(order)).filter(F.col("_before").isNull() | (F.col("_before") != F.col("text"))).drop("_before")


def drop_repeats(df: DataFrame, value: str, key: str, *order: str) -> DataFrame:
    """Rows whose value differs from that of the row before."""
    before = F.lag(value).over(W.partitionBy(key).orderBy(*order))
    return df.withColumn("_before", before).filter(~F.col("_before").eqNullSafe(F.col(value)) | F.col("_before").isNull()).drop("_before")


def segments(lines: DataFrame, heading: Column, key: str, order: str) -> DataFrame:
    """`lines` with segment: how many headings there are up to the line; 0 is what stands before the first."""
    return lines.withColumn("segment", F.sum(heading.cast("long")).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def first_marker(lines: DataFrame, marker: Column, key: str, order: str, out: str) -> DataFrame:
    """By key the first place where `marker` holds; null if it never does."""
    return lines.groupBy(key).agg(F.min(F.when(marker, F.col(order))).alias(out))


def until_marker(lines: DataFrame, marker: Column, key: str, order: str) -> DataFrame:
    """Lines before the first one for which `marker` holds."""
    stop = F.min(F.when(marker, F.col(order))).over(W.partitionBy(key))
    return lines.withColumn("_stop", stop).filter(F.col("_stop").isNull() | (F.col(order) < F.col("_stop"))).drop("_stop")


def positions(pages: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """`pages` with start and stop of each in the joined text, one separator between pages."""
    before = F.sum(F.length(text) + 1).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    return pages.withColumn("start", F.coalesce(before, F.lit(0)).cast("long")).withColumn("stop", (F.col("start") + F.length(text)).cast("long"))


def page_of(pages: DataFrame, points: DataFrame, key: str, order: str) -> DataFrame:
    """The page that holds each point (key, position); a point on a separator belongs to the page before it."""
    return points.join(pages.select(key, order, "start", "stop"), key).filter((F.col("position") >= F.col("start")) & (F.col("position") <= F.col("stop"))).drop("start", "stop")


def ahead(value: Column, rows: int, key: str, order: str) -> Column:
    """The smallest value in the following `rows` rows."""
    return F.min(value).over(W.partitionBy(key).orderBy(order).rowsBetween(1, rows))
