"""Page composition and counts by period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.stats import null0, percent, r6
from quillspark.operators.ranks import quantile, summarise
from quillspark.schema import NOTE_TYPES


def composition(records: DataFrame, *keys: str) -> DataFrame:
    """Mean pages in all, before opinions and in annexes; what opinions take is the rest of the means, 0 at least."""
    out = records.groupBy(*keys).agg(F.count("*").alias("documents"), *[F.avg(null0(F.col(c))).alias(c) for c in ("pages", "pages_before", "annex_pages")])
    rest = F.greatest(F.lit(0.0), F.col("pages") - F.col("pages_before") - F.col("annex_pages"))
    return out.select(*keys, "documents", r6(F.col("pages")).alias("pages"), r6(F.col("pages_before")).alias("pages_before"), r6(F.col("annex_pages")).alias("annex_pages"), r6(rest).alias("opinion_pages"))


def process_months(records: DataFrame) -> DataFrame:
    p = null0(F.col("pages"))
    afs = records.filter("month is not null and process is not null and template = 'AFS'")
    return summarise(afs, ["process", "month"], F.count("*").alias("documents"), r6(F.avg(p)).alias("pages_mean"), quantile(p, 0.5).alias("pages_median"))


def note_type_pivot(records: DataFrame, period: str = "month", types: list[str] | None = None) -> DataFrame:
    types = types or NOTE_TYPES
    out = records.filter(F.col(period).isNotNull()).groupBy(period).pivot("template", types).count()
    return out.select(period, *[F.coalesce(F.col(t), F.lit(0)).alias(t) for t in types])


def coverage_detail(records: DataFrame) -> DataFrame:
    """Of accepted note types: documents, those with an opinion and their share, first and last month."""
    return records.filter(F.col("template").isin(NOTE_TYPES)).groupBy("template").agg(
        F.count("*").alias("documents"), F.count_if(F.col("service_sections") > 0).alias("with_opinion"),
        percent(F.count_if(F.col("service_sections") > 0), F.count("*"), 4).alias("share"), F.min("month").alias("first_month"), F.max("month").alias("last_month"),
    )
