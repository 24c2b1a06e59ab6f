"""Record filters as lists of predicates."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.schema import NOTE_TYPES, SERVICES

SEARCHED = ["file_name", "template", "batch", "product", "author", "extraction", "process", "team_pj", "team_rm", "team_ju"]


@dataclass
class FilterState:
    """What a reader has chosen; an empty choice doesn't restrict."""

    templates: list[str] = field(default_factory=list)
    batches: list[str] = field(default_factory=list)
    extraction: str | None = None
    product: str | None = None
    author: str | None = None
    process: str | None = None
    year: int | None = None
    date_from: str | None = None
    date_to: str | None = None
    words_from: float | None = None
    words_to: float | None = None
    ged: str | None = None
    bo_from: str | None = None
    hide_future: bool = False
    service: str | None = None
    floor: float = 0.0
    only_issues: bool = False
    only_opinions: bool = False
    search: str = ""
    types: list[str] = field(default_factory=lambda: list(NOTE_TYPES))
    services: list[str] = field(default_factory=lambda: list(SERVICES))

    def predicates(self) -> list[Column]:
        out = [F.col("template").isin(self.types)]
        if self.templates:
            out.append(F.col("template").isin(self.templates))
        if self.batches:
            out.append(F.col("batch").isin(self.batches))
        out += [F.col(n) == v for n, v in (("extraction", self.extraction), ("product", self.product), ("author", self.author), ("process", self.process), ("year", self.year)) if v is not None]
        out += date_range(self.date_from, self.date_to)
        if self.words_from is not None:
            out.append(F.coalesce("words", F.lit(0.0)) >= self.words_from)
        if self.words_to is not None:
            out.append(F.coalesce("words", F.lit(0.0)) <= self.words_to)
        if self.service:
            out.append(F.coalesce(F.col(self.service), F.lit(0.0)) > self.floor)
        if self.ged is not None:
            out.append(F.coalesce("ged_status", F.lit(NO_GED)) == self.ged)
        if self.bo_from:
            out.append(F.col("bo_date").isNotNull() & (F.col("bo_date") >= F.lit(self.bo_from).cast("date")))
        if self.hide_future:
            out.append(~F.col("is_future"))
        if self.only_issues:
            out.append(has_issue())
        if self.only_opinions:
            out.append(has_opinion(self.services, self.floor))
        if self.search.strip():
            out.append(matches(self.search))
        return out

    def apply(self, records: DataFrame) -> DataFrame:
        return records.filter(reduce(lambda a, b: a & b, self.predicates()))

    def snapshot(self) -> dict:
        """All choices as plain values, to be kept and restored."""
        return asdict(self)

    @classmethod
    def restored(cls, snapshot: dict, domains: dict[str, list]) -> FilterState:
        """The state of a snapshot, less the choices that `domains` (choice to values that occur) no longer has."""
        known = {f.name for f in fields(cls)}
        kept = {k: v for k, v in snapshot.items() if k in known}
        for name in kept.keys() & domains.keys():
            held = set(domains[name])
            if isinstance(kept[name], list):
                kept[name] = [v for v in kept[name] if v in held]
            elif kept[name] is not None and kept[name] not in held:
                kept[name] = None
        kept["types"] = [t for t in kept.get("types", NOTE_TYPES) if t in NOTE_TYPES]
        return cls(**kept)

    def reset(self) -> FilterState:
        """No choice but the note types and services that there are."""
        return FilterState(services=list(self.services))

    def summary(self) -> str:
        """The choices that restrict, in words."""
        listed = {"Template": self.templates, "Batch": self.batches, "MC Note Type": self.types if self.types != NOTE_TYPES else []}
        parts = [f"{k}: {', '.join(v)}" for k, v in listed.items() if v]
        named = {"Extraction": self.extraction, "Product": self.product, "Author": self.author, "Process": self.process, "Year": self.year, "GED": self.ged}
        parts += [f"{k}: {v}" for k, v in named.items() if v is not None]
        if self.date_from or self.date_to:
            parts.append(f"Date: {self.date_from or '...'} to {self.date_to or '...'}")
        if self.words_from is not None or self.words_to is not None:
            parts.append(f"Words: {'...' if self.words_from is None else self.words_from} to {'...' if self.words_to is None else self.words_to}")
        said = {
            f"BO date >= {self.bo_from}": self.bo_from, f"Search: {self.search.strip()}": self.search.strip(), "Future dates hidden": self.hide_future, "Quality rows only": self.only_issues,
            "Opinions only": self.only_opinions, f"Service: {self.service}": self.service, f"Opinion floor: > {self.floor:g} words": self.floor > 0,
        }
        return " | ".join([*parts, *(text for text, holds in said.items() if holds)]) or "All records"


#: Fixed value: how a record without a match status is called.
NO_GED = "Missing GED status"


def date_range(first: str | None, last: str | None) -> list[Column]:
    """A first day leaves out undated records; a last day alone keeps them."""
    d = F.col("validation_date")
    out = []
    if first:
        out.append(d.isNotNull() & (d >= F.lit(first).cast("date")))
    if last:
        out.append(d.isNull() | (d <= F.lit(last).cast("date")))
    return out


def has_issue() -> Column:
    return ~F.col("has_date") | ~F.col("has_bo_date") | F.col("is_future")


def has_opinion(services: list[str], floor: float = 0.0) -> Column:
    return F.exists(F.array(*services), lambda x: F.coalesce(x > floor, F.lit(False)))


def matches(text: str, columns: list[str] | None = None) -> Column:
    """`text` anywhere in the columns, joined by spaces with null as the empty text; case doesn't count."""
    hay = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns or SEARCHED])
    return F.contains(F.lower(hay), F.lit(text.strip().lower()))


def domain(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
