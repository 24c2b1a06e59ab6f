"""Note files as a data source: pages, or facts of files, read by path where they are needed.

Files are listed once and dealt to partitions by their bytes. A task opens one file after another, so no row carries a
whole file. What is read depends on the columns that are asked for: with a schema of facts alone no text is decoded.
"""

from __future__ import annotations

import fnmatch
import importlib
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from quillspark.sources.files import listed, opened

PAGES = "path string, page_no int, page_text string, error string"
FACTS = "path string, size long, modified timestamp, pages int, error string"
#: Bytes of files that one partition reads, unless an option says otherwise.
PARTITION_BYTES = 64 << 20


def form_feed(content: bytes) -> list[str]:
    """Pages of a text file, parted by form feeds."""
    return content.decode("utf-8").split("\f")


def count_form_feeds(content: bytes) -> int:
    return content.count(b"\f") + 1


#: How files become pages: (decoder, how many pages there are without decoding any).
DECODERS: dict[str, tuple[Callable[[bytes], list[str]], Callable[[bytes], int]]] = {"form_feed": (form_feed, count_form_feeds)}


def decoder(name: str) -> tuple[Callable[[bytes], list[str]], Callable[[bytes], int] | None]:
    """A decoder by its name in DECODERS, or "module:function"; a function's attribute `count` counts pages for it."""
    if name in DECODERS:
        return DECODERS[name]
    module, _, function = name.partition(":")
    found = getattr(importlib.import_module(module), function)
    return found, getattr(found, "count", None)


class FileGroup(InputPartition):
    def __init__(self, files: list[tuple[str, int, float]]) -> None:
        super().__init__(files)
        self.files = files


class NotePages(DataSource):
    """Format "note_pages". Options: path, pattern, decode (see decoder), bytes (of a partition), filters (whether they are handed in).

    Its own columns are PAGES; with the schema FACTS, or some of its columns, a file is one row.
    """

    @classmethod
    def name(cls) -> str:
        return "note_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema: T.StructType) -> DataSourceReader:
        kind = FilteringPageReader if self.options.get("filters") == "true" else PageReader
        return kind(dict(self.options), [f.name for f in schema])


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str], columns: list[str]) -> None:
        known = {c.split()[0] for c in f"{PAGES}, {FACTS}".split(", ")}
        if strange := [c for c in columns if c not in known]:
            raise ValueError(f"no such columns: {', '.join(strange)}")
        self.root, self.pattern, self.decode = options["path"], options.get("pattern", "*.pdf"), options.get("decode", "form_feed")
        self.size, self.columns, self.paths = int(options.get("bytes", PARTITION_BYTES)), columns, None

    def partitions(self) -> list[InputPartition]:
        groups: list[list[tuple[str, int, float]]] = [[]]
        held = 0
        for path, size, modified in listed(self.root):
            if not fnmatch.fnmatch(path.rsplit("/", 1)[-1], self.pattern) or (self.paths is not None and path not in self.paths):
                continue
            if groups[-1] and held + size > self.size:
                groups.append([])
                held = 0
            groups[-1].append((path, size, modified))
            held += size
        return [FileGroup(g) for g in groups if g]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        by_page = bool({"page_no", "page_text"} & set(self.columns))
        decode, count = decoder(self.decode)
        for path, size, modified in partition.files:
            facts = {"path": path, "size": size, "modified": datetime.fromtimestamp(modified, UTC)}
            rows: list[dict] = [facts]
            try:
                if by_page:
                    with opened(path) as f:
                        rows = [facts | {"page_no": k, "page_text": t} for k, t in enumerate(decode(f.read()), 1)]
                elif {"pages", "error"} & set(self.columns):
                    with opened(path) as f:
                        facts["pages"] = count(f.read()) if count else len(decode(f.read()))
            except Exception as e:  # noqa: BLE001  what a decoder raises is data here
                rows = [facts | {"error": f"{type(e).__name__}: {e}"}]
            for r in rows:
                yield tuple(r.get(c) for c in self.columns)


class FilteringPageReader(PageReader):
    """The reader of sessions that hand filters to sources (spark.sql.python.filterPushdown.enabled); others refuse it."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Files that a filter on path leaves out aren't opened; the filter is applied again behind the source."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("path",):
                self.paths = {f.value} if self.paths is None else self.paths & {f.value}
            elif isinstance(f, In) and f.attribute == ("path",):
                self.paths = set(f.value) if self.paths is None else self.paths & set(f.value)
            yield f


def note_pages(spark: SparkSession, path: str, pattern: str = "*.pdf", decode: str = "form_feed", **options: str | int) -> DataFrame:
    """(path, page_no, page_text, error): a file that can't be decoded is a row with its error, never a failed job."""
    return _source(spark, path, pattern, decode, options).load()


def note_facts(spark: SparkSession, path: str, pattern: str = "*.pdf", decode: str = "form_feed", **options: str | int) -> DataFrame:
    """(path, size, modified, pages, error): a row for each file."""
    return _source(spark, path, pattern, decode, options).schema(FACTS).load()


def _source(spark: SparkSession, path: str, pattern: str, decode: str, options: dict):
    spark.dataSource.register(NotePages)
    filters = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("note_pages").options(path=path, pattern=pattern, decode=decode, filters=filters, **options)
