"""Sources: files of notes, page texts, tables with unsure headers, mappings."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.joins import promote_header
from quillspark.schema import coerce, drop_empty_rows, with_missing_columns
from quillspark.sources.workbook import read_sheet

PageDecoder = Callable[[bytes], list[str]]


def note_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Every matching file below `path` with its bytes."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)


def page_texts(files: DataFrame, decode: PageDecoder) -> DataFrame:
    """(path, page_no, page_text, error): a file that can't be decoded is a row with its error, never a failed job."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows: list[tuple] = []
            for path, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    rows += [(path, k, text, None) for k, text in enumerate(decode(bytes(content)), 1)]
                except Exception as e:  # noqa: BLE001  what a decoder raises is data here
                    rows.append((path, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "page_no", "page_text", "error"]).astype({"page_no": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, page_no int, page_text string, error string")


def form_feed_pages(content: bytes) -> list[str]:
    """Pages of a text file, parted by form feeds."""
    return content.decode("utf-8").split("\f")


def pdf_pages(content: bytes) -> list[str]:
    """Pages of a PDF, where a decoder library is installed."""
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("no PDF decoder is installed; pass another decoder") from e
    with fitz.open(stream=io.BytesIO(content), filetype="pdf") as doc:
        return [page.get_text("text") or "" for page in doc]


def indexed_folders(spark: SparkSession, folders: dict[str, str], pattern: str = "*.pdf") -> DataFrame:
    """The files of several folders, each with its template."""
    parts = [note_files(spark, path, pattern).withColumn("template_folder", F.lit(name)) for name, path in folders.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("file_name", F.regexp_extract("path", r"([^/]+)$", 1))


def csv_table(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """A CSV table by its declared types; values that don't fit are null. Columns it lacks are there as null."""
    raw = drop_empty_rows(spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"', mode="PERMISSIVE"))
    return coerce(with_missing_columns(raw, schema), schema) if schema else raw


def unsure_header_table(spark: SparkSession, path: str, markers: list[str], sep: str = ",") -> DataFrame:
    """A CSV whose header is the line that names most of `markers`."""
    raw = spark.read.csv(path, header=False, sep=sep, mode="PERMISSIVE")
    numbered = raw.select(F.monotonically_increasing_id().alias("ordinal"), F.array(*raw.columns).alias("cells"))
    return promote_header(numbered, "cells", "ordinal", markers)[0].drop("ordinal")


def payload(spark: SparkSession, path: str, rows: str = "records") -> DataFrame:
    """The records of one JSON document."""
    return spark.read.json(path, multiLine=True).select(F.explode(rows).alias("r")).select("r.*")


def excel_sheet(spark: SparkSession, path: str, sheet: str, header: int = 1, schema: T.StructType | None = None) -> DataFrame:
    """A sheet of a workbook whose header is the row of index `header`, rows without a value left out.

    Cells are strings unless `schema` says more: then values that don't fit are null, as are columns that are missing.
    """
    raw = read_sheet(spark, path, sheet, header)
    return coerce(with_missing_columns(raw, schema), schema) if schema else raw


#: A mapping that is read to the driver has so many rows at most; a longer one is an error, never cut.
MOST_PREFIXES = 10_000


def mapping_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(prefix, merge_to) of a CSV whose header may stand anywhere and be written in any case."""
    raw = spark.read.csv(path, header=False, sep=sep, mode="PERMISSIVE")
    lowered = F.array(*[F.regexp_replace(F.lower(F.trim(c)), r"[\s_]+", "_") for c in raw.columns])
    numbered = raw.select(F.monotonically_increasing_id().alias("ordinal"), F.array(*raw.columns).alias("cells"), lowered.alias("keys"))
    best = numbered.orderBy(F.desc(F.size(F.array_intersect("keys", F.array(F.lit("prefix"), F.lit("merge_to"))))), "ordinal").first()
    if not {"prefix", "merge_to"} <= set(best["keys"]):
        raise ValueError("no line names the columns prefix and merge_to")
    places = {name: best["keys"].index(name) for name in ("prefix", "merge_to")}
    body = numbered.filter(F.col("ordinal") > best["ordinal"])
    return drop_empty_rows(body.select(*[F.get("cells", F.lit(k)).alias(name) for name, k in places.items()]))


def prefix_mapping(rows: DataFrame, outputs: list[str], fallback: dict[str, str]) -> tuple[dict[str, str], list[str]]:
    """(prefix to group, warnings) of a small table (prefix, merge_to); `fallback` where it has no complete row."""
    found, warnings = {}, []
    known = {o.upper(): o for o in outputs}
    listed = rows.select("prefix", "merge_to").limit(MOST_PREFIXES + 1).collect()
    if len(listed) > MOST_PREFIXES:
        raise ValueError(f"a mapping of more than {MOST_PREFIXES} rows is no table of prefixes")
    for r in listed:
        prefix, group = ((x or "").strip() for x in r)
        if prefix and group:
            found[prefix] = known.get(group.upper(), group)
        elif prefix or group:
            warnings.append(f"incomplete row: {prefix or '-'} to {group or '-'}")
    return (found, warnings) if found else (dict(fallback), [*warnings, "built-in mapping used"])
