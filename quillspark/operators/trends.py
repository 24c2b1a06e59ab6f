"""Time series, rolling values, momentum and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.stats import mean, null0, r6, rate
from quillspark.operators.ranks import quantile, summarise
from quillspark.operators.summaries import unpivot_services

#: Periods by (after, until, name); the left end is open.
PERIODS = [("2017-12-31", "2020-12-31", "2018-2020"), ("2020-12-31", "2022-12-31", "2021-2022"), ("2022-12-31", "2024-12-31", "2023-2024"), ("2024-12-31", "2026-12-31", "2025-2026")]


def period_bins(records: DataFrame, periods: list[tuple[str, str, str]]) -> DataFrame:
    """By period and template; a day on a period's left end belongs to the one before."""
    label = F.coalesce(*[F.when((F.col("validation_date") > F.lit(a).cast("date")) & (F.col("validation_date") <= F.lit(b).cast("date")), F.lit(name)) for a, b, name in periods])
    binned = records.withColumn("period", label).filter("period is not null")
    return summarise(
        binned, ["period", "template"],
        F.count("*").alias("documents"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"), quantile("pages", 0.5).alias("pages_median"), quantile("service_words", 0.5).alias("service_median"),
    )


def monthly(records: DataFrame) -> DataFrame:
    return summarise(records.filter("month is not null"), ["template", "month"], F.count("*").alias("documents"), quantile("words", 0.5).alias("words_median"), quantile("pages", 0.5).alias("pages_median"))


def rolling(series: DataFrame, value: str, out: str, key: str = "template", order: str = "month", size: int = 3, least: int = 2) -> DataFrame:
    """The mean over the last `size` present rows, null for fewer than `least` values, and its difference to the row before."""
    near = W.partitionBy(key).orderBy(order).rowsBetween(1 - size, 0)
    with_mean = series.withColumn(out, F.when(F.count(value).over(near) >= least, r6(F.avg(value).over(near))))
    return with_mean.withColumn(f"{out}_change", r6(F.col(out) - F.lag(out).over(W.partitionBy(key).orderBy(order))))


def monthly_rolling(records: DataFrame) -> DataFrame:
    return rolling(rolling(monthly(records), "words_median", "words_rolling"), "pages_median", "pages_rolling")


def shortening_points(records: DataFrame, top: int = 6, least: int = 5) -> DataFrame:
    """The `top` largest drops of the rolling median of each template, in months with `least` documents."""
    rows = monthly_rolling(records).filter((F.col("documents") >= least) & F.col("words_rolling_change").isNotNull())
    rank = F.row_number().over(W.partitionBy("template").orderBy(F.asc_nulls_last("words_rolling_change"), "month"))
    return rows.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("template", "month", "documents", "words_rolling", "words_rolling_change", "rank")


def change_points(records: DataFrame, metrics: list[str], top: int = 3) -> DataFrame:
    """The `top` largest month-to-month falls of the median of each metric in each template."""
    medians = summarise(records.filter("month is not null"), ["template", "month"], *[quantile(m, 0.5).alias(m) for m in metrics])
    long = medians.unpivot(["template", "month"], metrics, "metric", "median")
    delta = r6(F.col("median") - F.lag("median").over(W.partitionBy("template", "metric").orderBy("month")))
    ranked = long.withColumn("delta", delta).filter("delta is not null")
    rank = F.row_number().over(W.partitionBy("template", "metric").orderBy(F.asc_nulls_last("delta"), "month"))
    return ranked.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)


def service_years(records: DataFrame, services: list[str]) -> DataFrame:
    long = unpivot_services(records.filter("year is not null"), services, "note_id", "year")
    has = F.col("words") > 0
    return long.groupBy("service", "year").agg(
        F.count_if(has).alias("opinions"), F.round(F.sum(null0(F.col("words"))), 2).alias("words"), F.count("*").alias("documents"), rate(has, 4).alias("coverage"),
    )


def two_bases(records: DataFrame, period: str = "year") -> DataFrame:
    """The same measures by two dates, stacked: one pass, two rows for each record."""
    basis = F.explode(F.array(F.struct(F.lit("database").alias("basis"), F.col("validation_date").alias("day")), F.struct(F.lit("corrected").alias("basis"), F.coalesce("bo_date", "validation_date").alias("day"))))
    rows = records.select("template", "words", "pages", basis.alias("b")).select("template", "words", "pages", "b.*").filter("day is not null")
    key = F.year("day").cast("long") if period == "year" else F.trunc("day", "month")
    return summarise(rows.withColumn(period, key), ["basis", period, "template"], F.count("*").alias("documents"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"), quantile("pages", 0.5).alias("pages_median"))


def momentum(records: DataFrame, services: list[str], recent: int = 6) -> DataFrame:
    """Opinions of the last `recent` months against those of as many before.

    The months are the distinct ones of records that are not in the future, whatever their gaps. Opinions themselves
    are not held to that calendar's end, so a future one counts only if its month is in it.
    """
    months = records.filter("month is not null and not is_future").select("month").distinct()
    # The calendar has a row for each month, so one task ranks it.
    calendar = months.withColumn("back", F.row_number().over(W.orderBy(F.desc("month")))).filter(F.col("back") <= 2 * recent)
    long = unpivot_services(records.filter("month is not null"), services, "note_id", "template", "month").filter("words > 0")
    # 2 * `recent` rows.
    placed = long.join(F.broadcast(calendar), "month").withColumn("now", F.col("back") <= recent)
    w = F.col("words")
    out = summarise(
        placed, ["template", "service"],
        F.count_if(F.col("now")).alias("recent_count"), F.count_if(~F.col("now")).alias("previous_count"),
        F.round(F.coalesce(F.sum(F.when(F.col("now"), w)), F.lit(0.0)), 2).alias("recent_words"), F.round(F.coalesce(F.sum(F.when(~F.col("now"), w)), F.lit(0.0)), 2).alias("previous_words"),
        F.coalesce(r6(F.avg(F.when(F.col("now"), w))), F.lit(0.0)).alias("recent_mean"), F.coalesce(r6(F.avg(F.when(~F.col("now"), w))), F.lit(0.0)).alias("previous_mean"),
        quantile(F.when(F.col("now"), w), 0.5).alias("recent_median"), quantile(F.when(~F.col("now"), w), 0.5).alias("previous_median"),
    ).fillna(0.0, ["recent_median", "previous_median"])
    return out.withColumns({"count_delta": F.col("recent_count") - F.col("previous_count"), "mean_delta": r6(F.col("recent_mean") - F.col("previous_mean")), "median_delta": r6(F.col("recent_median") - F.col("previous_median"))})


def trend_signal(records: DataFrame, services: list[str], top: int = 8) -> DataFrame:
    """Services whose length or number moves, the strongest `top` of each template."""
    m = momentum(records, services)
    longer, more = F.col("mean_delta"), F.col("count_delta")
    signal = (
        F.when((longer > 25) & (more > 10), "longer and more").when((longer < -25) & (more < -10), "shorter and fewer").when(longer > 25, "longer").when(longer < -25, "shorter")
        .when(more > 10, "more").when(more < -10, "fewer").otherwise("steady")
    )
    scored = m.withColumns({"signal": signal, "score": r6(F.abs("mean_delta") + F.abs("median_delta") + 8 * F.abs("count_delta"))})
    rank = F.row_number().over(W.partitionBy("template").orderBy(F.desc("score"), "service"))
    return scored.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("template", "service", "signal", "score", "mean_delta", "median_delta", "count_delta", "rank")


def moving_average(records: DataFrame, size: int = 3) -> DataFrame:
    """Documents by month and template and their mean over the last `size` present months; one is enough."""
    counts = records.filter("month is not null").groupBy("template", "month").agg(F.count("*").alias("documents"))
    near = W.partitionBy("template").orderBy("month").rowsBetween(1 - size, 0)
    return counts.withColumn("moving", r6(F.avg("documents").over(near)))


def running_total(records: DataFrame) -> DataFrame:
    counts = records.filter("month is not null").groupBy("template", "month").agg(F.count("*").alias("documents"))
    return counts.withColumn("total", F.sum("documents").over(W.partitionBy("template").orderBy("month").rowsBetween(W.unboundedPreceding, 0)))


#: What a chart may show, by name: the measure of a group and its label. Names that aren't known show pages.
TREND_METRICS = {"words": (lambda: mean("words"), "Mean Text Before Opinions"), "pages": (lambda: mean("pages"), "Mean Pages")}
PAGE_METRICS = {
    "annex_pages": (lambda: r6(F.avg(null0(F.col("annex_pages")))), "Mean Annex Pages"), "pages_before": (lambda: r6(F.avg(null0(F.col("pages_before")))), "Mean Pre-Opinion Pages"),
    "pages": (lambda: r6(F.avg(null0(F.col("pages")))), "Mean Total Pages"),
}
MOMENTUM_METRICS = {"mean_words": ("mean_delta", "Mean delta"), "median_words": ("median_delta", "Median delta")}


def trend_of(records: DataFrame, metric: str, period: str = "month", family: dict | None = None) -> DataFrame:
    """The chosen measure by period and template, with its label; undated records are left out."""
    family = TREND_METRICS if family is None else family
    measure, label = family.get(metric, family["pages"])
    return records.filter(F.col(period).isNotNull()).groupBy(period, "template").agg(F.count("*").alias("documents"), measure().alias("value")).withColumn("label", F.lit(label))


def momentum_of(rows: DataFrame, metric: str) -> DataFrame:
    """The chosen change of each service, the mean one for a name that isn't known."""
    column, label = MOMENTUM_METRICS.get(metric, MOMENTUM_METRICS["mean_words"])
    return rows.select("template", "service", F.col(column).alias("value"), F.lit(label).alias("label"))
