"""Data tests: each returns findings, and a summary has one row for each test."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.stats import null0, r6, rate
from quillspark.operators.ranks import quantile, summarise
from quillspark.operators.summaries import unpivot_services
from quillspark.sources.sinks import write_csv


def unexpected_services(records: DataFrame, services: list[str], template: str, expected: list[str]) -> DataFrame:
    """Words of a template under services that it doesn't have."""
    others = [s for s in services if s not in expected]
    return unpivot_services(records.filter(F.col("template") == template), others, "note_id", "template").filter("words > 0")


def coverage(records: DataFrame, template: str, services: list[str], least: float = 65.0) -> DataFrame:
    long = unpivot_services(records.filter(F.col("template") == template), services, "note_id")
    return long.groupBy("service").agg(F.count("*").alias("documents"), rate(F.col("words") > 0, 4).alias("coverage")).withColumn("status", F.when(F.col("coverage") >= least, "pass").otherwise("warn"))


def exceeds_total(records: DataFrame, services: list[str]) -> DataFrame:
    """Services with more words than the whole text."""
    return unpivot_services(records.withColumnRenamed("words", "total"), services, "note_id", "template", "total").filter(F.col("words") > F.col("total"))


def high_ratio(records: DataFrame, most: float = 1.25) -> DataFrame:
    ratio = F.try_divide(F.col("service_words"), F.nullif("words", F.lit(0.0)))
    return records.withColumn("ratio", r6(ratio)).filter(ratio > most).select("note_id", "template", "words", "service_words", "ratio")


def flagged(records: DataFrame, which: Column) -> DataFrame:
    return records.filter(which).select("note_id", "template", "validation_date", "bo_date")


def iqr_outliers(records: DataFrame, factor: float = 1.5) -> DataFrame:
    """Records outside the quartiles by `factor` times their distance; the low bound is 0 at least."""
    q = summarise(records, ["template"], quantile("words", 0.25, 6).alias("q1"), quantile("words", 0.75, 6).alias("q3"))
    spread = F.col("q3") - F.col("q1")
    bounds = q.select("template", F.greatest(F.lit(0.0), F.col("q1") - factor * spread).alias("low"), (F.col("q3") + factor * spread).alias("high"))
    # A row for each template.
    return records.join(F.broadcast(bounds), "template").filter((F.col("words") < F.col("low")) | (F.col("words") > F.col("high"))).select("note_id", "template", "words", r6(F.col("low")).alias("low"), r6(F.col("high")).alias("high"))


def manual_against_automated(records: DataFrame) -> DataFrame:
    """Median words by extraction, in templates that have both."""
    side = lambda e: quantile(F.when(F.col("extraction") == e, F.col("words")), 0.5)
    g = summarise(records, ["template"], side("Manual").alias("manual_median"), side("Automated").alias("automated_median"))
    return g.filter("manual_median is not null and automated_median is not null").withColumn("difference", r6(F.col("manual_median") - F.col("automated_median")))


def only_under(records: DataFrame, service: str, allowed: list[str]) -> DataFrame:
    """Templates in which a service has words, and whether all of them are allowed."""
    found = records.filter(F.col(service) > 0).agg(F.array_sort(F.collect_set("template")).alias("found"))
    extra = F.array_except("found", F.array(*[F.lit(a) for a in allowed]))
    return found.select(F.array_join("found", ", ").alias("found"), F.array_join(extra, ", ").alias("unexpected"), F.when(F.size(extra) == 0, "pass").otherwise("warn").alias("status"))


def missing_ged(records: DataFrame) -> DataFrame:
    """Records without a match status of the document store: information, not a fault."""
    return records.filter(F.col("ged_status").isNull()).select("note_id", "template", "validation_date", "bo_date")


def status(n: Column) -> Column:
    return F.when(n == 0, "pass").otherwise("warn")


#: The share of notes that a service must be in, the ratio of all services to the text, and how many quartile
#: distances beyond the quartiles an outlier begins.
LEAST_COVERAGE, MOST_RATIO, IQR_FACTOR = 0.65, 1.25, 1.5


def test_summary(records: DataFrame, services: list[str], expected: list[str], template: str = "GNG", least: float = LEAST_COVERAGE, factor: float = IQR_FACTOR) -> DataFrame:
    """test, status, metric, unit: one row for each data test, in one pass over the records.

    Findings of a service are counted once for each record and service. A template's quartiles and medians come first and
    are a row for each template.
    """
    others = [s for s in services if s not in expected]
    total = lambda flags: F.sum(sum((f.cast("long") for f in flags), F.lit(0)))
    mine = F.col("template").eqNullSafe(template)
    words = null0(F.col("words"))
    q = summarise(
        records, ["template"],
        quantile("words", 0.25, 6).alias("_q1"), quantile("words", 0.75, 6).alias("_q3"),
        F.count_if((F.col("extraction") == "Manual") & F.col("words").isNotNull()).alias("_manual"), F.count_if((F.col("extraction") == "Automated") & F.col("words").isNotNull()).alias("_automated"),
    )
    both = q.agg(F.count_if((F.col("_manual") > 0) & (F.col("_automated") > 0) & F.col("template").isNotNull()).alias("both"))
    spread = factor * (F.col("_q3") - F.col("_q1"))
    # A row for each template: small by nature.
    bounds = q.select(F.col("template").alias("_template"), F.greatest(F.lit(0.0), F.col("_q1") - spread).alias("_low"), (F.col("_q3") + spread).alias("_high")).filter("_template is not null")
    judged = records.join(F.broadcast(bounds), F.col("template") == F.col("_template"), "left")
    outside = (F.col("words") < F.col("_low")) | (F.col("words") > F.col("_high"))
    row = judged.agg(
        total([mine & (null0(F.col(s)) > 0) for s in others]).alias("unexpected"),
        *[F.round(100 * F.try_divide(F.count_if(mine & (null0(F.col(s)) > 0)), F.greatest(F.count_if(mine), F.lit(1))), 2).alias(f"coverage {s}") for s in sorted(expected)],
        total([null0(F.col(s)) > words for s in services]).alias("exceeds"),
        F.count_if(F.try_divide(F.col("service_words"), F.nullif("words", F.lit(0.0))) > MOST_RATIO).alias("ratio"),
        F.count_if("is_future").alias("future"), F.count_if(~F.col("has_date")).alias("no date"), F.count_if(F.col("ged_status").isNull()).alias("no ged"), F.count_if(~F.col("has_bo_date")).alias("no bo date"),
        F.count_if(outside).alias("outliers"), F.count_if(null0(F.col("SG")) > 0).alias("sg"), F.count_if((null0(F.col("SG")) > 0) & ~F.col("template").eqNullSafe("OTHER")).alias("sg elsewhere"),
    ).join(F.broadcast(both))
    entry = lambda test, state, metric, unit: F.struct(F.lit(test).alias("test"), state.alias("status"), metric.cast("double").alias("metric"), F.lit(unit).alias("unit"))
    info = F.lit("info")
    tests = [
        entry("gng-unexpected-departments", status(F.col("unexpected")), F.col("unexpected"), "rows"),
        *[entry(f"gng-{s.lower()}-coverage", F.when(F.col(f"coverage {s}") >= 100 * least, "pass").otherwise("warn"), F.col(f"coverage {s}"), "% rows positive") for s in sorted(expected)],
        entry("single-department-exceeds-total", status(F.col("exceeds")), F.col("exceeds"), "rows"),
        entry("department-total-ratio", status(F.col("ratio")), F.col("ratio"), "rows"),
        entry("future-validation-dates", status(F.col("future")), F.col("future"), "rows"),
        entry("missing-validation-dates", status(F.col("no date")), F.col("no date"), "rows"),
        entry("missing-ged-status", F.when(F.col("no ged") > 0, "info").otherwise("pass"), F.col("no ged"), "rows"),
        entry("missing-bo-validation-dates", status(F.col("no bo date")), F.col("no bo date"), "rows"),
        entry("word-count-iqr-outliers", info, F.col("outliers"), "rows"),
        entry("manual-automated-median-difference", info, F.col("both"), "templates"),
        entry("sg-template-distribution", status(F.col("sg elsewhere")), F.col("sg"), "rows"),
    ]
    return row.select(F.explode(F.array(*tests)).alias("t")).select("t.*")


def detail_rows(tests: dict[str, DataFrame], most: int = 25) -> DataFrame:
    """The first `most` findings of each test, by note and what it found: test, note_id, template, department, value."""
    parts = []
    for name, df in tests.items():
        have = lambda c, kind, df=df: (F.col(c) if c in df.columns else F.lit(None)).cast(kind)
        value = next((c for c in ("ratio", "words") if c in df.columns), "none")
        listed = df.select(F.lit(name).alias("test"), "note_id", "template", have("service", "string").alias("department"), have(value, "double").alias("value"))
        parts.append(listed.orderBy("note_id", "department").limit(most))
    return reduce(DataFrame.unionByName, parts)


def write_tests(summary: DataFrame, details: DataFrame, path: str) -> None:
    """The tests as JSON, their summary and their findings as CSV."""
    found = details.groupBy("test").agg(F.array_sort(F.collect_list(F.struct("note_id", "department", "template", "value"))).alias("rows"))
    summary.join(found, "test", "left").coalesce(1).write.mode("overwrite").json(f"{path}/tests")
    write_csv(summary, f"{path}/tests_summary", bom=True)
    write_csv(details, f"{path}/tests_detail", bom=True)
