"""Quality rules whose thresholds come from mergeable quantile sketches of each language and source.

Every text is measured once. Fixed rules sort out texts too short or too repetitive to be judged. The measures of the
others go into sketches: a sketch counts integers in buckets that grow with the value (exact below 128, then 64 to each
power of two, so a quantile is off by less than 1/64), and sketches merge by adding counts, which Spark does before the
shuffle. Quartiles of a language and source give its fences; a group of few documents takes the merged sketches of its
language, or of all. The fences are joined back and every document is judged by those of its own group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.arrow_words import owners, runs_of, word_numbers
from quillspark.llm.common import lookup, release, settle

#: The characters that count as symbols, and the rules that don't adapt.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Fences lie so many interquartile ranges outside of the quartiles.
FENCE = 3
#: A group with fewer documents takes the thresholds of its language, or of all documents.
LEAST_DOCS = 100
#: (measure, value, least interquartile range, whether low values fail too). The least ranges leave room for what chance
#: makes of the shortest texts that are judged, where one line that stands twice is a quarter of the words.
MEASURES = [
    ("chars_per_100_words", lambda: F.expr("100 * word_chars div n_words"), 40, True),
    ("symbols_per_1000_words", lambda: F.expr("1000 * n_symbols div n_words"), 30, False),
    ("dup_lines_per_1000", lambda: F.expr("1000 * n_dup_lines div n_lines"), 150, False),
    ("repeats_per_1000_words", lambda: F.expr("1000 * n_repeat_words div n_words"), 100, False),
]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeated_words(numbers: np.ndarray, first: np.ndarray, size: int = 3) -> np.ndarray:
    """For each text how many of its words lie in a window of `size` words that it holds twice or more."""
    texts = len(first) - 1
    if len(numbers) < size:
        return np.zeros(texts, "i8")
    text = owners(first)
    # A word of one text is another than that of any other text, so windows need no text of their own.
    own = np.unique(text * (int(numbers.max()) + 1) + numbers, return_inverse=True)[1].astype("i8")
    most, windows = int(own.max()) + 1, own[: len(own) - size + 1]
    for k in range(1, size):
        windows = np.unique(windows * most + own[k : k + len(windows)], return_inverse=True)[1].astype("i8")
    inside = text[: len(windows)] == text[size - 1 :]
    twice = np.bincount(windows[inside], minlength=int(windows.max()) + 1)[windows] > 1
    covered = np.zeros(len(own), bool)
    for at in range(size):
        covered[at : at + len(windows)] |= twice & inside
    return np.bincount(text[covered], minlength=texts)


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, those of them that are equal to an earlier one) for each text."""
    listed = pc.split_pattern(texts, "\n")
    lines = listed.flatten()
    text = np.repeat(np.arange(len(texts)), np.diff(listed.offsets.to_numpy()))
    worded = pc.binary_length(pc.ascii_trim_whitespace(lines)).to_numpy(zero_copy_only=False) > 0
    number = lines.dictionary_encode().indices.to_numpy().astype("i8")
    n = np.bincount(text[worded], minlength=len(texts))
    apart = np.unique(text[worded] * (len(lines) + 1) + number[worded]) // (len(lines) + 1)
    return n, n - np.bincount(apart, minlength=len(texts))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, texts in runs_of(batch.column(3)):
            numbers, first, words = word_numbers(texts)
            sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype("i8")
            chars = np.append(0, np.cumsum(sizes[numbers]))
            symbols = sum(pc.count_substring(texts, c).to_numpy(zero_copy_only=False).astype("i8") for c in SYMBOLS)
            lines, dup_lines = _lines(texts)
            found = [np.diff(first), chars[first[1:]] - chars[first[:-1]], symbols, lines, dup_lines, repeated_words(numbers, first)]
            keys = [batch.column(k)[at : at + len(texts)] for k in range(3)]
            yield pa.RecordBatch.from_arrays([*keys, *[pa.array(x, pa.int64()) for x in found]], names=["id", "lang", "source", *COUNTS])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """id, lang, source and COUNTS of every row; a null text has none of anything."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).cast("string").alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return rows.mapInArrow(_measure, "id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))


def bucket(value: Column) -> Column:
    """The bucket of an integer from 0 on."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - 7)
    return (shift * 64 + F.call_function("shiftright", value, shift)).cast("long")


def least_of(number: Column) -> Column:
    """The least integer of a bucket."""
    shift = F.greatest(F.lit(0), F.floor(number / 64).cast("int") - 1)
    return F.call_function("shiftleft", number - shift * 64, shift).cast("long")


def sketches(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure (its place in MEASURES), cell, n: the sketches of every group, a row for each bucket in use."""
    values = F.array(*[F.struct(F.lit(k).alias("measure"), bucket(value()).alias("cell")) for k, (_, value, _, _) in enumerate(MEASURES)])
    return rows.select(*keys, F.inline(values)).groupBy(*keys, "measure", "cell").agg(F.count("*").alias("n"))


def merged(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups: counts of equal buckets are added."""
    return cells.groupBy(*keys, "measure", "cell").agg(F.sum("n").alias("n"))


def fences(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, docs, fences (low, high of each measure): quartiles of the sketches, FENCE interquartile ranges outwards.

    A group holds a few hundred buckets for each measure at most, however many documents it counts.
    """
    group = W.partitionBy(*keys, "measure")
    upto = F.sum("n").over(group.orderBy("cell").rowsBetween(W.unboundedPreceding, 0))
    ranked = cells.withColumns({"upto": upto, "docs": F.sum("n").over(group)})
    found = ranked.groupBy(*keys, "measure").agg(
        F.max("docs").alias("docs"),
        least_of(F.min(F.when(F.col("upto") * 4 >= F.col("docs"), F.col("cell")))).alias("q1"),
        least_of(F.min(F.when(F.col("upto") * 4 >= F.col("docs") * 3, F.col("cell")))).alias("q3"),
    )
    least = F.element_at(F.array(*[F.lit(x) for _, _, x, _ in MEASURES]), F.col("measure") + 1)
    wide = F.greatest(F.col("q3") - F.col("q1"), least) * FENCE
    both = F.element_at(F.array(*[F.lit(x) for _, _, _, x in MEASURES]), F.col("measure") + 1)
    pair = F.struct("measure", F.when(both, F.col("q1") - wide).alias("low"), (F.col("q3") + wide).alias("high"))
    return found.groupBy(*keys).agg(F.max("docs").alias("docs"), F.array_sort(F.collect_list(pair)).alias("fences"))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS) -> DataFrame:
    """id, COUNTS, base_failed, kept, reason for each row of `docs`; reason names the rules that it fails, joined by commas.

    base_failed: fewer than 50 words, or more than half of the words in windows of three that the text holds twice. Such
    documents don't enter a sketch. Of the others those are kept whose measures all lie within the fences of their language
    and source; a null language or source is a value of its own. A group with fewer than `least_docs` of them takes its
    language's fences, a language with fewer those of all. A null text has no words, so it fails. Repeated rows are each
    counted and judged; an empty table stays empty; other columns are ignored, whatever their names.
    """
    rows = settle(measures(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", F.expr(f"n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words")), "measured")
    cells = settle(sketches(rows.filter("not base_failed"), ["lang", "source"]), "cells")
    # One row, whatever the input.
    of_all = fences(merged(cells, []), []).first()
    sides = {x.measure: (x.low, x.high) for x in of_all.fences}
    last = F.array(*[F.struct(F.lit(k).alias("measure"), *[F.lit(x).cast("long").alias(n) for n, x in zip(("low", "high"), sides.get(k, (None, None)), strict=True)]) for k in range(len(MEASURES))])
    groups = rows.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    enough = F.col("docs") >= least_docs
    own = fences(cells, ["lang", "source"]).filter(enough).select(F.col("lang").alias("l"), F.col("source").alias("s"), F.col("fences").alias("own"))
    ours = settle(groups.join(own, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left").select("lang", "source", "rows", "own"), "groups")
    spoken = ours.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("sources"))
    by_lang = fences(merged(cells, ["lang"]), ["lang"]).filter(enough).join(spoken, F.col("lang").eqNullSafe(F.col("of"))).select("lang", "fences", "sources")
    chosen = lookup(ours, by_lang, "lang", "sources", max(1, ours.count()), F.xxhash64("source"))
    limits = settle(chosen.select(F.struct("lang", "source").alias("key"), "rows", F.coalesce("own", "fences", last).alias("fences")), "limits")
    release(cells, ours)
    judged = lookup(rows.withColumn("key", F.struct("lang", "source")), limits, "key", "rows", max(1, rows.count()), F.xxhash64("id", *COUNTS))
    outside = [F.when((value() < F.col("fences")[k]["low"]) | (value() > F.col("fences")[k]["high"]), F.lit(name)) for k, (name, value, _, _) in enumerate(MEASURES)]
    reasons = F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(F.array_compact(F.array(*[F.when(F.coalesce(x.isNotNull(), F.lit(False)), x) for x in outside])))
    return judged.select(F.col("id").alias(id_col), *COUNTS, "base_failed", (F.size(reasons) == 0).alias("kept"), F.array_join(reasons, ",").alias("reason"))
