"""The note types that are known, and what reads and checks each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quillspark.operators.accuracy import compare, document_stats, field_pairs, field_stats, overall
from quillspark.operators.extraction import extract_afs, extract_gng, extract_other
from quillspark.operators.ordering import seeded_sample
from quillspark.schema import SERVICES
from quillspark.stages import settle


@dataclass(frozen=True)
class NoteType:
    """How the notes of one type become rows of (doc_id, page_no, page_text)."""

    extract: Callable[[DataFrame], DataFrame]
    folder: str
    #: The fields that an accuracy run compares, and those of them that are dates.
    fields: tuple[str, ...] = ("pages", "pages_before", "annex_pages", "words", *SERVICES)
    dates: tuple[str, ...] = ()
    enabled: bool = True
    notes: str = ""


REGISTRY = {
    "GNG": NoteType(extract_gng, "gng"),
    "AFS": NoteType(extract_afs, "afs"),
    "OTHER": NoteType(extract_other, "other"),
}


def known_type(name: str, registry: dict[str, NoteType] | None = None) -> NoteType:
    """The entry of a type; case doesn't count. One that isn't known, or isn't enabled, is an error that says so."""
    known = REGISTRY if registry is None else registry
    found = known.get(name.upper())
    if found is None:
        raise KeyError(f"unknown note type {name}; known are {', '.join(sorted(known))}")
    if not found.enabled:
        raise ValueError(f"{name.upper()} is registered but not enabled: {found.notes}")
    return found


def dispatch(name: str, pages: DataFrame, registry: dict[str, NoteType] | None = None) -> DataFrame:
    """The rows of the notes in `pages` by the reader of their type."""
    return known_type(name, registry).extract(pages)


@dataclass(frozen=True)
class AccuracyRun:
    """What an accuracy run of one type found: every compared field, and its sums by field, by document and over all."""

    compared: DataFrame
    fields: DataFrame
    documents: DataFrame
    overall: DataFrame


def accuracy_run(name: str, pages: DataFrame, visible: DataFrame, limit: int | None = None, seed: int = 20260529, method: str = "random", registry: dict[str, NoteType] | None = None) -> AccuracyRun:
    """The notes of a type, all or a sample of `limit`, extracted and compared field by field with `visible` (doc_id, fields)."""
    found = known_type(name, registry)
    if limit is not None:
        drawn = seeded_sample(pages.select("doc_id").distinct(), limit, seed, "doc_id", method=method)
        pages, visible = (df.join(drawn, "doc_id", "left_semi") for df in (pages, visible))
    fields = list(found.fields)
    compared = settle(compare(field_pairs(found.extract(pages), visible, "doc_id", fields), list(found.dates)), "compared")
    return AccuracyRun(compared, field_stats(compared), document_stats(compared, "doc_id"), overall(compared, "doc_id"))
