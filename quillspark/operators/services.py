"""Service opinions: the records' service columns as rows, and what is counted over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.stats import mean, null0, percent, r6
from quillspark.operators.ranks import quantile, summarise
from quillspark.operators.summaries import unpivot_services


def opinions(records: DataFrame, services: list[str], floor: float = 0.0) -> DataFrame:
    """A row for each dated record and service with more than `floor` words."""
    return unpivot_services(records.filter("month is not null"), services, "note_id", "template", "product", "month").filter(F.col("words") > floor)


def opinion_summary(records: DataFrame, services: list[str], floor: float = 0.0) -> DataFrame:
    return summarise(
        opinions(records, services, floor), ["template", "service"],
        F.count("*").alias("opinions"), F.round(F.sum("words"), 2).alias("words"), F.countDistinct("note_id").alias("documents"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"),
    )


def service_mix(records: DataFrame, services: list[str], top: int) -> DataFrame:
    """The `top` services by opinions in each template, with their share of the template's opinions."""
    counts = opinions(records, services).groupBy("template", "service").agg(F.count("*").alias("opinions"), F.round(F.sum("words"), 2).alias("words"))
    inside = W.partitionBy("template")
    ranked = counts.withColumns({"share": percent(F.col("opinions"), F.sum("opinions").over(inside), 4), "rank": F.row_number().over(inside.orderBy(F.desc("opinions"), "service")).cast("long")})
    return ranked.filter(F.col("rank") <= top)


def service_volume(records: DataFrame, services: list[str], top: int = 12) -> DataFrame:
    grouped = summarise(opinions(records, services), ["service"], F.count("*").alias("opinions"), F.round(F.sum("words"), 2).alias("words"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"))
    return grouped.orderBy(F.desc("opinions"), "service").limit(top)


def opinion_coverage(records: DataFrame, services: list[str], period: str) -> DataFrame:
    """The share of records of each period and template with an opinion, and the mean of the shares of the period."""
    has = F.exists(F.array(*services), lambda x: F.coalesce(x > 0, F.lit(False)))
    grouped = records.filter(F.col(period).isNotNull()).groupBy(period, "template").agg(F.count("*").alias("documents"), F.count_if(has).alias("with_opinion"))
    shared = grouped.withColumn("coverage", percent(F.col("with_opinion"), F.col("documents"), 4))
    return shared.withColumn("period_mean", r6(F.avg("coverage").over(W.partitionBy(period))))


def service_pulse(records: DataFrame, services: list[str]) -> DataFrame:
    """Opinions of every template, service and month, 0 where there are none: the axes are small, the facts are not."""
    counts = opinions(records, services).groupBy("template", "service", "month").agg(F.count("*").alias("opinions"))
    dated = records.filter("month is not null")
    months, templates = dated.select("month").distinct(), dated.select("template").distinct()
    listed = F.explode(F.array(*[F.lit(s) for s in services]))
    # One row for each month and template that occur, never one for each pair of records.
    grid = months.agg(F.collect_set("month").alias("months")).join(templates).select("template", F.explode("months").alias("month")).withColumn("service", listed)
    return grid.join(counts, ["template", "service", "month"], "left").withColumn("opinions", F.coalesce("opinions", F.lit(0)))


def product_stats(records: DataFrame, services: list[str]) -> DataFrame:
    docs = summarise(
        records, ["product"],
        F.count("*").alias("documents"), F.countDistinct("template").alias("templates"), quantile(null0(F.col("words")), 0.5).alias("words_median"),
        percent(F.count("bo_date"), F.count("*")).alias("bo_coverage"),
    )
    ops = opinions(records, services).groupBy("product").agg(F.count("*").alias("opinions"))
    return docs.join(ops, "product", "left").withColumn("opinions", F.coalesce("opinions", F.lit(0)))


def without_pin(records: DataFrame) -> DataFrame:
    """What service views look at: all records but those of template PIN; a record without a template stays."""
    return records.filter(~F.col("template").eqNullSafe("PIN"))
