"""Where texts stand on pages: blocks and spans with their boxes, and the facts of a file.

What decodes a file is a function of its bytes, so that any library, or a fixture, can stand behind these readers. A file
that can't be decoded is a row with its error, never a failed job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.dates import meta_date


class Box(NamedTuple):
    """One block or span: its page (from 1) and that page's size, its corners from the top left, its text."""

    page_no: int
    page_w: float
    page_h: float
    x0: float
    y0: float
    x1: float
    y1: float
    text: str


class Facts(NamedTuple):
    """What a file says of itself: pages, the raw dates of its metadata, the texts of its pages."""

    pages: int
    created: str | None
    modified: str | None
    texts: list[str]


BoxDecoder = Callable[[bytes], Iterable[Box]]
FactsDecoder = Callable[[bytes], Facts]

#: What readers of boxes give: the columns that header_dates and top_right take.
LAYOUT = "path string, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, text string, ord int, error string"


def layout_boxes(files: DataFrame, decode: BoxDecoder) -> DataFrame:
    """The boxes of each of `files` (path, content), numbered by `ord` in the decoder's order within a page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows: list[tuple] = []
            for path, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    seen: dict[int, int] = {}
                    found = []
                    for box in decode(bytes(content)):
                        seen[box.page_no] = seen.get(box.page_no, 0) + 1
                        found.append((path, *box, seen[box.page_no], None))
                    rows += found
                except Exception as e:  # noqa: BLE001  what a decoder raises is data here
                    rows.append((path, *[None] * 9, f"{type(e).__name__}: {e}"))
            names = [c.split()[0] for c in LAYOUT.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"page_no": "Int32", "ord": "Int32"} | {c: "float64" for c in names[2:8]})

    return files.select("path", "content").mapInPandas(run, LAYOUT)


def file_facts(files: DataFrame, decode: FactsDecoder, pages: int = 2) -> DataFrame:
    """path, pages, created, modified, first_text (of the first `pages` pages), error of each file."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows: list[tuple] = []
            for path, content in zip(pdf.path, pdf.content, strict=True):
                try:
                    facts = decode(bytes(content))
                    rows.append((path, facts.pages, facts.created, facts.modified, "\n".join(facts.texts[:pages]), None))
                except Exception as e:  # noqa: BLE001
                    rows.append((path, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "pages", "created", "modified", "first_text", "error"]).astype({"pages": "Int64"})

    found = files.select("path", "content").mapInPandas(run, "path string, pages long, created string, modified string, first_text string, error string")
    return found.withColumns({c: meta_date(F.col(c)) for c in ("created", "modified")})


def pdf_boxes(kind: str = "blocks") -> BoxDecoder:
    """Blocks, or spans, of a PDF, where a decoder library is installed."""

    def decode(content: bytes) -> Iterator[Box]:
        for no, page in enumerate(_opened(content), 1):
            size = (page.rect.width, page.rect.height)
            if kind == "blocks":
                for x0, y0, x1, y1, text, *_ in page.get_text("blocks"):
                    yield Box(no, *size, x0, y0, x1, y1, text)
            else:
                for block in page.get_text("dict")["blocks"]:
                    for span in (s for line in block.get("lines", []) for s in line["spans"]):
                        yield Box(no, *size, *span["bbox"], span["text"])

    return decode


def pdf_facts(content: bytes) -> Facts:
    doc = _opened(content)
    return Facts(doc.page_count, doc.metadata.get("creationDate"), doc.metadata.get("modDate"), [page.get_text("text") or "" for page in doc])


def _opened(content: bytes):
    try:
        import fitz
    except ImportError as e:
        raise RuntimeError("no PDF decoder is installed; pass another decoder") from e
    return fitz.open(stream=content, filetype="pdf")
