"""Descriptive summaries of records. Each function takes records (see derive.derive) and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.stats import mean, null0, percent, r6, rate
from quillspark.operators.ranks import Quantile, quantile, summarise


def compact_stats() -> list[Column | Quantile]:
    """22 measures of a group. Nulls are skipped; standard deviation has n - 1 below and is null for one value."""
    manual, auto = F.count_if(F.col("extraction") == "Manual"), F.count_if(F.col("extraction") == "Automated")
    return [
        F.count("*").alias("documents"), manual.alias("manual"), auto.alias("automated"), percent(manual, F.count("*")).alias("manual_rate"),
        F.round(F.sum("words"), 2).alias("words_sum"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"),
        quantile("words", 0.25).alias("words_p25"), quantile("words", 0.75).alias("words_p75"), quantile("words", 0.9).alias("words_p90"),
        r6(F.stddev_samp("words")).alias("words_std"), F.min("words").alias("words_min"), F.max("words").alias("words_max"),
        r6(F.avg("pages")).alias("pages_mean"), quantile("pages", 0.5).alias("pages_median"),
        r6(F.avg("pages_before")).alias("pages_before_mean"), r6(F.avg("annex_pages")).alias("annex_mean"),
        r6(F.avg("words_per_page")).alias("per_page_mean"), r6(F.avg("words_per_pre_page")).alias("per_pre_page_mean"),
        r6(F.avg("service_words")).alias("service_words_mean"), F.min("validation_date").alias("first_date"), F.max("validation_date").alias("last_date"),
    ]


def overview(records: DataFrame, *keys: str) -> DataFrame:
    return summarise(records, list(keys), *compact_stats())


def overview_sets(records: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """The measures of several groupings in one pass: grouping, the union of their keys, measures.

    A row of records stands once for each grouping, with null in the keys that it doesn't group by, before one partial
    aggregation and one shuffle; `grouping` tells a key that is null from one that isn't grouped by.
    """
    keys = list(dict.fromkeys(k for own in sets.values() for k in own))
    kinds = dict(records.dtypes)
    rows = [F.struct(F.lit(name).alias("grouping"), *[(F.col(k) if k in own else F.lit(None).cast(kinds[k])).alias(f"_{k}") for k in keys]) for name, own in sets.items()]
    spread = records.withColumn("_g", F.explode(F.array(*rows))).select("*", "_g.*").drop("_g")
    return summarise(spread, ["grouping", *[f"_{k}" for k in keys]], *compact_stats()).withColumnsRenamed({f"_{k}": k for k in keys})


def time_series(records: DataFrame, period: str) -> DataFrame:
    """By period and template; undated records are left out."""
    return overview(records.filter(F.col(period).isNotNull()), period, "template")


def unpivot_services(records: DataFrame, services: list[str], *ids: str) -> DataFrame:
    """One row for each record and service, null words included."""
    return records.select(*ids, *services).unpivot(list(ids), services, "service", "words")


def department_totals(records: DataFrame, services: list[str]) -> DataFrame:
    long = unpivot_services(records, services, "template")
    grouped = summarise(
        long, ["template", "service"],
        F.count("words").alias("filled"), F.count_if(F.col("words") > 0).alias("positive"), F.round(F.sum(null0(F.col("words"))), 2).alias("words_sum"),
        mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"), quantile("words", 0.9).alias("words_p90"),
    )
    return grouped.withColumn("share", percent(F.col("words_sum"), F.sum("words_sum").over(W.partitionBy("template")), 4))


def extraction_effect(records: DataFrame) -> DataFrame:
    return summarise(
        records, ["template", "extraction"],
        F.count("*").alias("documents"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"),
        r6(F.avg("pages")).alias("pages_mean"), quantile("service_words", 0.5).alias("service_words_median"),
    )


def product_overview(records: DataFrame) -> DataFrame:
    return summarise(
        records, ["product"],
        F.count("*").alias("documents"), F.array_join(F.array_sort(F.collect_set("template")), ", ").alias("templates"), F.count("bo_date").alias("with_bo_date"),
        mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"), F.min("validation_date").alias("first_date"), F.max("validation_date").alias("last_date"),
    )


def mode_by_group(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The most frequent value of each group, the smallest of equally frequent ones; nulls don't count."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(out))


def team_rows(records: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """(service, team, words, note_id, product) for each service and the column that names its team."""
    rows = F.explode(F.array(*[F.struct(F.lit(s).alias("service"), F.col(t).alias("team"), F.col(s).alias("words")) for s, t in pairs.items()]))
    out = records.select("note_id", "product", rows.alias("r")).select("note_id", "product", "r.*")
    return out.filter((F.col("words") > 0) & F.col("team").isNotNull() & ~F.upper(F.trim("team")).isin("#", "N/A", "NA", "NONE", ""))


def team_opinions(records: DataFrame, pairs: dict[str, str]) -> DataFrame:
    rows = team_rows(records, pairs)
    stats = summarise(
        rows, ["service", "team"],
        F.count("*").alias("opinions"), F.countDistinct("note_id").alias("documents"), F.round(F.sum("words"), 2).alias("words_sum"), mean("words").alias("words_mean"),
        quantile("words", 0.5).alias("words_median"), F.min("words").alias("words_min"), F.max("words").alias("words_max"),
    )
    return stats.join(mode_by_group(rows, ["service", "team"], "product", "top_product"), ["service", "team"], "left")


def team_extremes(records: DataFrame, pairs: dict[str, str], least: int = 3) -> DataFrame:
    """The teams of each service with the highest and the lowest median, among those with `least` opinions."""
    stats = summarise(team_rows(records, pairs), ["service", "team"], F.count("*").alias("opinions"), quantile("words", 0.5).alias("words_median")).filter(F.col("opinions") >= least)
    high = F.row_number().over(W.partitionBy("service").orderBy(F.desc("words_median"), F.desc("opinions"), "team"))
    low = F.row_number().over(W.partitionBy("service").orderBy("words_median", F.desc("opinions"), "team"))
    ranked = stats.withColumns({"high": high, "low": low})
    ends = F.array_compact(F.array(F.when(F.col("high") == 1, F.lit("highest")), F.when(F.col("low") == 1, F.lit("lowest"))))
    return ranked.filter("high = 1 or low = 1").select("service", F.explode(ends).alias("extreme"), "team", "opinions", "words_median")


def bo_delta_summary(records: DataFrame) -> DataFrame:
    d = F.col("delta_days")
    row = summarise(
        records, [],
        F.count("*").cast("double").alias("rows"), F.count("bo_date").cast("double").alias("with_date"), F.count_if(F.col("bo_date").isNull()).cast("double").alias("without_date"),
        F.count_if(d == 0).cast("double").alias("same_day"), F.count_if(d < 0).cast("double").alias("before"), F.count_if(d > 0).cast("double").alias("after"),
        quantile("delta_days", 0.5).alias("median_days"), r6(F.avg("delta_days")).alias("mean_days"),
    )
    return row.unpivot([], row.columns, "metric", "value")


def bo_delta_histogram(records: DataFrame) -> DataFrame:
    """Records by the distance of the two dates; a missing distance is a bucket of its own."""
    d = F.col("delta_days")
    bucket = (
        F.when(d.isNull(), "No date").when(d == 0, "Same day").when(d < -30, "Over 30 days before").when(d < 0, "1-30 days before")
        .when(d <= 30, "1-30 days after").when(d <= 90, "31-90 days after").otherwise("Over 90 days after")
    )
    return records.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("documents"))


def correlations(records: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise complete correlations, all in one pass over the records; each pair is computed once and stands on both sides."""
    place = {a: k for k, a in enumerate(columns)}
    once = [(a, b) for a in columns for b in columns if place[a] <= place[b]]
    row = records.agg(*[F.corr(a, b).alias(f"c{place[a]}_{place[b]}") for a, b in once])
    value = lambda a, b: F.round(F.nanvl(F.col(f"c{min(place[a], place[b])}_{max(place[a], place[b])}"), F.lit(None)), 4)
    listed = F.explode(F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), value(a, b).alias("corr")) for a in columns for b in columns]))
    return row.select(listed.alias("p")).select("p.*")


#: The flags of a record's quality, in the reports' order.
FLAGS = {
    "Missing validation date": lambda: F.col("validation_date").isNull(),
    "Future validation date": lambda: F.col("is_future"),
    "Missing annex page count": lambda: F.col("annex_pages").isNull(),
    "Missing BO validation date": lambda: F.col("bo_date").isNull(),
}
#: The flags that the dashboard counts.
SHOWN_FLAGS = {"Missing date": "Missing validation date", "Future date": "Future validation date", "Missing BO date": "Missing BO validation date"}


def quality_flags(records: DataFrame) -> DataFrame:
    """A row for each record and flag that it has; a record may have several. One pass, where a union would make four."""
    flags = F.array_compact(F.array(*[F.when(rule(), F.lit(name)) for name, rule in FLAGS.items()]))
    return records.select(F.explode(flags).alias("flag"), "note_id", "batch", "template", "extraction", "file_name", "validation_date", "bo_date", "pages", "words", "product")


def quality_flag_counts(records: DataFrame) -> DataFrame:
    """(flag, n) for each flag of the dashboard, flags without a record included."""
    row = records.agg(*[F.count_if(FLAGS[name]()).alias(shown) for shown, name in SHOWN_FLAGS.items()])
    return row.unpivot([], list(SHOWN_FLAGS), "flag", "n")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def kpis(records: DataFrame, services: list[str]) -> DataFrame:
    """The dashboard's measures, which take null for 0."""
    w, p = null0(F.col("words")), null0(F.col("pages"))
    return summarise(
        records, [],
        F.count("*").alias("documents"), F.countDistinct("template").alias("templates"), F.countDistinct("batch").alias("batches"), F.countDistinct("author").alias("authors"),
        F.round(F.sum(w), 2).alias("words_sum"), r6(F.avg(w)).alias("words_mean"), quantile(w, 0.5).alias("words_median"),
        r6(F.avg(p)).alias("pages_mean"), quantile(p, 0.5).alias("pages_median"), r6(F.avg(null0(F.col("annex_pages")))).alias("annex_mean"),
        rate(F.col("extraction") == "Manual").alias("manual_rate"), rate(F.col("service_sections") > 0).alias("opinion_rate"),
        F.min("validation_date").alias("first_date"), F.max("validation_date").alias("last_date"),
    )


def authors(records: DataFrame, least: int, *keys: str) -> DataFrame:
    """By author (and `keys`), authors that are not null and have `least` documents."""
    return summarise(
        records.filter("author is not null"), ["author", *keys],
        F.count("*").alias("documents"), mean("words").alias("words_mean"), quantile("words", 0.5).alias("words_median"),
        rate(F.col("extraction") == "Manual").alias("manual_rate"), r6(F.avg("pages")).alias("pages_mean"), F.max("validation_date").alias("last_date"),
    ).filter(F.col("documents") >= least)


def author_effect(records: DataFrame, least: int) -> DataFrame:
    """Median words of an author in a template against the template's median over records with an author."""
    known = records.filter("author is not null")
    base = summarise(known, ["template"], quantile("words", 0.5).alias("template_median"))
    own = summarise(known, ["template", "author"], F.count("*").alias("documents"), quantile("words", 0.5).alias("author_median")).filter(F.col("documents") >= least)
    return own.join(base, "template").withColumn("effect", r6(F.col("author_median") - F.col("template_median")))


def author_ranks(records: DataFrame, least: int) -> DataFrame:
    own = records.filter("author is not null").groupBy("template", "author").agg(F.count("*").alias("documents"), mean("words").alias("words_mean")).filter(F.col("documents") >= least)
    return own.withColumn("rank", F.dense_rank().over(W.partitionBy("template").orderBy(F.desc("words_mean"))).cast("long"))


def author_coverage(records: DataFrame) -> DataFrame:
    return records.groupBy("template").agg(F.count("*").alias("documents"), F.count_if(F.col("author").isNull()).alias("missing"), rate(F.col("author").isNull()).alias("missing_rate"))


def box_percentiles(records: DataFrame) -> DataFrame:
    w = null0(F.col("words"))
    return summarise(records, ["template"], *[quantile(w, q / 100).alias(f"p{q}") for q in (5, 25, 50, 75, 95)])


def calendar(records: DataFrame) -> DataFrame:
    """Documents by year, a column for each month."""
    out = records.filter("validation_date is not null").withColumn("_m", F.month("validation_date")).groupBy("year").pivot("_m", list(range(1, 13))).count()
    return out.select("year", *[F.coalesce(F.col(str(m)), F.lit(0)).alias(f"m{m}") for m in range(1, 13)])


def department_matrix(records: DataFrame, services: list[str], top: int = 10) -> DataFrame:
    """Words by service and template for the `top` services by words."""
    long = unpivot_services(records, services, "template").groupBy("service", "template").agg(F.round(F.sum(null0(F.col("words"))), 2).alias("words"))
    totals = long.groupBy("service").agg(F.sum("words").alias("total")).orderBy(F.desc("total"), "service").limit(top)
    # `top` rows.
    return long.join(F.broadcast(totals), "service").select("service", "template", "words")


def batches(records: DataFrame) -> DataFrame:
    return summarise(
        records, ["batch"],
        F.count("*").alias("documents"), F.array_join(F.array_sort(F.collect_set("template")), ", ").alias("templates"),
        rate(F.col("extraction") == "Manual").alias("manual_rate"), quantile(null0(F.col("words")), 0.5).alias("words_median"), F.min("validation_date").alias("first_date"), F.max("validation_date").alias("last_date"),
    )
