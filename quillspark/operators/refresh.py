"""A refresh of the dashboard: the active view is written, and what the page shows beside it is measured on the way."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quillspark.functions.stats import null0
from quillspark.operators.filters import FilterState

#: The columns whose values the filters offer, and how many values one may offer: more are an error, never cut.
DOMAINS, MOST_VALUES = ("template", "extraction", "batch", "product", "ged_status"), 10_000


@dataclass(frozen=True)
class Refreshed:
    """What a refresh shows: records in all and in the view, the view's measures and dates, the values of the filters."""

    total: int
    shown: int
    measures: dict[str, Any]
    domains: dict[str, list[str]]
    status: str


def _measures() -> dict[str, Column]:
    w, p = null0(F.col("words")), null0(F.col("pages"))
    return {
        "documents": F.count(F.lit(1)), "words_sum": F.round(F.sum(w), 2), "words_mean": F.round(F.avg(w), 6), "pages_mean": F.round(F.avg(p), 6),
        "annex_mean": F.round(F.avg(null0(F.col("annex_pages"))), 6), "manual": F.count_if(F.col("extraction") == "Manual"), "with_opinions": F.count_if(F.col("service_sections") > 0),
        "first_date": F.min("validation_date"), "last_date": F.max("validation_date"),
    }


def refresh(records: DataFrame, state: FilterState, path: str, columns: list[str] | None = None) -> Refreshed:
    """Write the records that pass `state` to `path`, and measure them and the filters' values in the same single job.

    Means, counts and dates are taken as rows pass by, those of all records before the filter and those of the view behind
    it. Values of filters are gathered as sets, a few for each column by nature; a column of more than MOST_VALUES is an
    error. Medians need an order of all values and aren't among these measures (see summaries.kpis).
    """
    everything, view = Observation(), Observation()
    offered = [F.collect_set(c).alias(c) for c in DOMAINS]
    passed = state.apply(records.observe(everything, F.count(F.lit(1)).alias("total"), *offered)).observe(view, *[c.alias(n) for n, c in _measures().items()])
    (passed.select(*columns) if columns else passed).write.mode("overwrite").parquet(path)
    before, found = everything.get, view.get
    domains = {c: sorted(before[c]) for c in DOMAINS}
    for c, values in domains.items():
        if len(values) > MOST_VALUES:
            raise ValueError(f"{c} has {len(values)} values; a filter offers {MOST_VALUES} at most")
    dates = f"{found['first_date']} to {found['last_date']}" if found["first_date"] else "No dated rows"
    return Refreshed(before["total"], found["documents"], found, domains, f"{found['documents']:,} of {before['total']:,} records, {dates}")
