"""Column names and types of note records, and helpers that bring tables to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The reviewing services, in the order of the record's columns.
SERVICES = ["OPS", "GLO", "PJ", "RM", "OCCO", "JU", "ECON", "CFC", "EIF", "FI", "IG", "PMM", "SG", "GIS", "HR", "OTHER"]
#: Note types that analyses accept, and all templates in report order.
NOTE_TYPES = ["AFS", "GNG", "OTHER"]
TEMPLATES = ["AFS", "GNG", "OTHER", "PIN"]
#: Fixed value: the day of analysis; later dates count as future.
ANALYSIS_DATE = "2026-06-02"
#: Fixed value: a back-office date that stands for none in timelines.
NO_DATE = "2000-01-01"
MISSING_PRODUCT = "Missing product"

RECORD = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("note_id", T.LongType()), ("template", T.StringType()), ("extraction", T.StringType()), ("batch", T.StringType()),
        ("file_name", T.StringType()), ("product", T.StringType()), ("author", T.StringType()), ("process", T.StringType()), ("ged_status", T.StringType()),
        ("validation_date", T.DateType()), ("bo_date", T.DateType()), ("words", T.DoubleType()), ("pages", T.DoubleType()),
        ("pages_before", T.DoubleType()), ("annex_pages", T.DoubleType()),
    )]
    + [T.StructField(s, T.DoubleType()) for s in SERVICES]
)


def with_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` that `df` lacks, added as null; the others stay as they are."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name.lower() not in have})


def select_existing(df: DataFrame, order: list[str]) -> DataFrame:
    """`order` first, without what is missing, then the rest as it stands."""
    first = [c for c in order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Every column of `schema` cast to its type, null where the value doesn't fit, and NaN to null."""
    out = {}
    for f in schema:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        c = c.cast(f.dataType) if dict(df.dtypes)[f.name] == f.dataType.simpleString() else c.try_cast(f.dataType)
        out[f.name] = F.when(~F.isnan(c), c) if isinstance(f.dataType, T.DoubleType) else c
    return df.withColumns(out)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")
