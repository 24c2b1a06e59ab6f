"""From typed note rows to analysed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.stats import row_positive, row_sum, safe_ratio
from quillspark.schema import ANALYSIS_DATE, MISSING_PRODUCT, NO_DATE, SERVICES


def template_label(c: Column) -> Column:
    """Upper case, trimmed; null stays null and is shown as missing where a report does so."""
    return F.upper(F.trim(c))


def product_label(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(MISSING_PRODUCT))


def quarter_label(d: Column, space: str = " ") -> Column:
    return F.concat(F.year(d).cast("string"), F.lit(space + "Q"), F.quarter(d).cast("string"))


def timeline_date(d: Column) -> Column:
    """The date that stands for none becomes null."""
    return F.nullif(d, F.lit(NO_DATE).cast("date"))


def derive(df: DataFrame, services: list[str] | None = None) -> DataFrame:
    """Adds the columns that analyses work on; the input has the columns of schema.RECORD."""
    services = services or [s for s in SERVICES if s in df.columns]
    day = F.lit(ANALYSIS_DATE).cast("date")
    return df.withColumns({
        "template": template_label(F.col("template")),
        "product": product_label(F.col("product")),
        "extraction": F.trim("extraction"),
    }).withColumns({
        "service_words": row_sum(services),
        "service_sections": row_positive(services),
        "words_per_page": safe_ratio(F.col("words"), F.col("pages")),
        "words_per_pre_page": safe_ratio(F.col("words"), F.col("pages_before")),
        "month": F.trunc("validation_date", "month"),
        "year": F.year("validation_date").cast("long"),
        "quarter": quarter_label(F.col("validation_date")),
        "bo_month": F.trunc("bo_date", "month"),
        "bo_year": F.year("bo_date").cast("long"),
        "delta_days": F.datediff("bo_date", "validation_date").cast("long"),
        "has_date": F.col("validation_date").isNotNull(),
        "has_bo_date": F.col("bo_date").isNotNull(),
        "is_future": F.coalesce(F.col("validation_date") > day, F.lit(False)),
    })
