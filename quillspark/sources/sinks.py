"""Sinks: CSV, JSON, one folder for each table, and small markdown tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = ",", single: bool = False, bom: bool = False) -> None:
    """A CSV folder with a header and columns in the given order; text in quotes with quotes doubled.

    With `bom` the folder holds one file that begins with the byte order mark, as spreadsheets want it for UTF-8.
    """
    out = df.select(*columns) if columns else df
    if bom:
        options = {"sep": sep, "quoteAll": "true", "escape": '"', "dateFormat": "yyyy-MM-dd"}
        lines = out.select(F.to_csv(F.struct(*[F.col(c).cast("string").alias(c) for c in out.columns]), options).alias("value"))
        head = sep.join('"' + c.replace('"', '""') + '"' for c in out.columns)
        first = df.sparkSession.createDataFrame([("\ufeff" + head,)], "value string")
        # The header's partition comes first, and coalescing keeps the order of partitions.
        first.coalesce(1).union(lines).coalesce(1).write.mode("overwrite").text(path)
        return
    (out.coalesce(1) if single else out).write.mode("overwrite").csv(path, header=True, sep=sep, quoteAll=True, escape='"')


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """One Parquet folder for each table."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def write_payload(tables: Mapping[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")


def serialised(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd, times in ISO form, NaN as null: what the JSON of a report holds."""
    out = {}
    for name, kind in df.dtypes:
        if kind == "date":
            out[name] = F.date_format(name, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            out[name] = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss")
        elif kind in ("double", "float"):
            out[name] = F.nanvl(F.col(name), F.lit(None).cast(kind))
    return df.withColumns(out) if out else df


def markdown(df: DataFrame, rows: int = 50) -> str:
    """The first rows of an ordered report as a markdown table."""
    cells = [[("" if v is None else str(v)).replace("|", "\\|") for v in r] for r in df.limit(rows).collect()]
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(c) + " |" for c in cells])
