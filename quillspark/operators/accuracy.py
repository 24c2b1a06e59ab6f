"""Field-by-field comparison of two extractions of the same documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.stats import percent, r6

NUMBER = r"^-?\d+(?:\.\d+)?$"


def normalised(c: Column) -> Column:
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(F.lower(t) == "none", "").otherwise(t)


def date_text(c: Column) -> Column:
    m = [F.regexp_extract(c, r"(\d{2})[./](\d{2})[./](\d{4})", k) for k in (1, 2, 3)]
    return F.when(m[0] == "", "").otherwise(F.concat_ws("/", *m))


def compare(pairs: DataFrame, dates: list[str]) -> DataFrame:
    """`pairs` (doc, field, script_value, actual_value) with normal forms, delta, match and status.

    Values that are both numbers match by value, others by normal text; fields in `dates` are compared as dates. The
    relative delta is null where the actual value is 0.
    """
    raw = pairs.withColumns({"script_norm": normalised(F.col("script_value")), "actual_norm": normalised(F.col("actual_value"))})
    number = lambda c: F.when(F.col(c).rlike(NUMBER), F.col(c).try_cast("double"))
    both = raw.withColumns({"_s": number("script_norm"), "_a": number("actual_norm")})
    is_date = F.col("field").isin(dates)
    normed = both.withColumns({n: F.when(is_date, date_text(F.col(n))).otherwise(F.col(n)) for n in ("script_norm", "actual_norm")})
    delta = F.col("_s") - F.col("_a")
    match = F.when(delta.isNotNull(), delta == 0).otherwise(F.col("script_norm") == F.col("actual_norm"))
    status = F.when((F.col("script_norm") == "") & (F.col("actual_norm") == ""), "both blank").when(match, "match").otherwise("mismatch")
    return normed.withColumns({"delta": delta, "pct_delta": F.try_divide(delta, F.nullif("_a", F.lit(0.0))), "match": match, "status": status}).drop("_s", "_a")


def field_pairs(script: DataFrame, actual: DataFrame, doc: str, fields: list[str]) -> DataFrame:
    """Both wide tables by document and field; documents that only one has are there with nulls on the other side."""
    long = lambda df, name: df.select(doc, *[F.col(f).cast("string").alias(f) for f in fields]).unpivot(doc, fields, "field", name)
    return long(script, "script_value").join(long(actual, "actual_value"), [doc, "field"], "full")


def field_stats(compared: DataFrame) -> DataFrame:
    d = F.abs("delta")
    return compared.groupBy("field").agg(
        F.count("*").alias("compared"), F.count_if("match").alias("matches"), F.count_if(~F.col("match")).alias("mismatches"), percent(F.count_if("match"), F.count("*"), 4).alias("match_rate"),
        r6(F.avg(d)).alias("mean_abs_delta"), r6(F.max(d)).alias("max_abs_delta"),
    )


def document_stats(compared: DataFrame, doc: str) -> DataFrame:
    wrong = F.when(~F.col("match"), F.col("field"))
    return compared.groupBy(doc).agg(F.count("*").alias("compared"), F.count_if("match").alias("matches"), F.array_join(F.array_sort(F.collect_list(wrong)), ", ").alias("mismatched"))


def overall(compared: DataFrame, doc: str) -> DataFrame:
    per = compared.groupBy(doc).agg(F.count("*").alias("n"), F.count_if("match").alias("m"))
    return per.agg(F.count("*").alias("documents"), F.sum("n").alias("compared"), F.sum("m").alias("matches"), percent(F.sum("m"), F.sum("n"), 4).alias("match_rate"), F.count_if(F.col("n") == F.col("m")).alias("perfect"))
