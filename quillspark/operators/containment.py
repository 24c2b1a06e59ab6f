"""Which names stand inside which texts: an automaton over the names reads each text once.

Names are dealt to blocks, and texts to spans, of bounded size; every span meets every block of its group in one task,
which builds the block's automaton and runs it over the span. What comes out is what a text found, or what found a name,
summed up in the task: never a row for each pair. The work grows with texts times blocks of names.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names of one automaton, and texts of one task.
BLOCK, SPAN = 50_000, 200_000
FOUND = "grp string, text string, low {kind}, high {kind}"


def _automaton(names: list[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for k, name in enumerate(names):
        found.add_word(name, k)
    found.make_automaton()
    return found


def _given(found: dict[str, list], group: str, kind: pa.DataType) -> pa.Table:
    return pa.table({
        "grp": pa.array([group] * len(found), pa.string()), "text": pa.array(list(found), pa.string()),
        "low": pa.array([x[0] for x in found.values()], kind), "high": pa.array([x[1] for x in found.values()], kind),
    })


def _meet(held_by_text: bool):
    """Least and greatest value for each text of the names inside it, or for each name of the texts around it."""

    def run(key: tuple, texts: pa.Table, names: pa.Table) -> pa.Table:
        valued = names if held_by_text else texts
        found: dict[str, list] = {}
        if len(texts) and len(names):
            listed = names["text"].to_pylist()
            low, high = valued["low"].to_pylist(), valued["high"].to_pylist()
            automaton = _automaton(listed)
            for k, text in enumerate(texts["text"].to_pylist()):
                for n in {n for _, n in automaton.iter(text)}:
                    at, v = (text, n) if held_by_text else (listed[n], k)
                    best = found.setdefault(at, [low[v], high[v]])
                    best[0], best[1] = min(best[0], low[v]), max(best[1], high[v])
        return _given(found, key[0].as_py(), valued["low"].type)

    return run


def held_and_holding(own: DataFrame, others: DataFrame, block: int = BLOCK, span: int = SPAN) -> DataFrame:
    """grp, text, low, high: for each text of `own` (grp, text) the least and greatest value of the rows of `others` (grp,
    text, low, high) whose text it contains or is contained in.

    Texts are strings that aren't empty, once each in a group; a null group meets nothing. Texts that meet none are left out.
    """
    kind = dict(others.dtypes)["low"]
    counted = others.groupBy("grp").agg(F.count("*").alias("others")).join(own.groupBy("grp").agg(F.count("*").alias("owns")), "grp")

    def dealt(texts: DataFrame, names: DataFrame, texts_n: str, names_n: str) -> tuple[DataFrame, DataFrame]:
        # A row for each group that both sides have.
        sizes = counted.select("grp", F.ceil(F.col(texts_n) / span).cast("int").alias("spans"), F.ceil(F.col(names_n) / block).cast("int").alias("blocks"))
        part = lambda c, n: F.pmod(F.xxhash64("text", F.lit(c)), F.col(n)).cast("int").alias(c)
        every = lambda n, c: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(c)
        a = texts.join(sizes, "grp").select(*texts.columns, part("span", "spans"), every("blocks", "block"))
        b = names.join(sizes, "grp").select(*names.columns, part("block", "blocks"), every("spans", "span"))
        return a, b

    keys = ["grp", "block", "span"]
    parts = []
    for texts, names, texts_n, names_n, by_text in ((own, others, "owns", "others", True), (others, own, "others", "owns", False)):
        a, b = dealt(texts, names, texts_n, names_n)
        parts.append(a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(_meet(by_text), FOUND.format(kind=kind)))
    return parts[0].unionByName(parts[1]).groupBy("grp", "text").agg(F.min("low").alias("low"), F.max("high").alias("high"))
