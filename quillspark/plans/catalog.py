"""The registry of named queries: a callable (spark, sf_dir) and, where SQL can say it, an equivalent query."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MODULES = ["summaries", "trends", "services", "pages", "ordering", "joins", "checks", "accuracy", "inference", "texts", "extraction"]


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its own name or `name`, with its equivalent in SQL."""

    def add(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql:
            ORACLES[key] = sql
        return fn

    return add


def load() -> None:
    for m in MODULES:
        importlib.import_module(f"quillspark.plans.{m}_plans")


load()
