"""Integration: null-safe joins, match cascades, lookups with fallbacks, grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.operators.containment import held_and_holding


def first_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key, the first in the source's order; a null key is a key."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("_row")).select(key, "_row.*")


def null_safe_left_join(notes: DataFrame, projects: DataFrame, left: str, right: str, order: str) -> DataFrame:
    """Each note with the first project of its key; null keys match each other. Spark broadcasts the projects if they are small."""
    one = first_rows(projects, right, order)
    return notes.join(one, notes[left].eqNullSafe(one[right]), "left").drop(one[right])


def master_columns(df: DataFrame) -> DataFrame:
    """What a note takes from its project, by template. Input: template, validation_date, bo_afs_date, bo_pin_gng_date, bo_author, bo_product, bo_flag, bo_pj, bo_rm, bo_ju, bo_sg, bo_process."""
    t = F.upper(F.trim(F.coalesce("template", F.lit(""))))
    project = t.isin("AFS", "GNG")
    date = F.when(t == "OTHER", F.col("validation_date")).when(t == "AFS", F.col("bo_afs_date")).when(t.isin("GNG", "PIN"), F.col("bo_pin_gng_date"))
    mine = {"financing_product": "bo_product", "special_activities": "bo_flag", "BO PJ": "bo_pj", "BO RM": "bo_rm", "BO JU": "bo_ju", "BO ECON": "bo_sg"}
    out = df.withColumns({"BO Validation Date": date, "BO Author": F.when(t != "OTHER", F.col("bo_author"))} | {k: F.when(project, F.col(v)) for k, v in mine.items()} | {"New AFS Process": F.when(t == "AFS", F.col("bo_process")).otherwise("N/A")})
    return out.drop("bo_afs_date", "bo_pin_gng_date", "bo_author", "bo_product", "bo_flag", "bo_pj", "bo_rm", "bo_ju", "bo_sg", "bo_process")


def match_cascade(notes: DataFrame, files: DataFrame) -> DataFrame:
    """Each note's file by the first of four tiers that finds one.

    notes: id, template, name, clean; files: file, template, name, clean, ordinal. The tiers: the same name (the last
    such file), the only file of the template with the clean name, the only file at all with it, the only file of the
    template whose clean name contains the note's or lies in it. Whether a candidate is the only one is decided over all
    files, before earlier tiers take any. The last tier looks for all names of a template at once in each of its names, by
    an automaton, and keeps the least and greatest file that fits: the two are the same where it is the only one.
    """
    exact = files.groupBy("name").agg(F.max_by("file", "ordinal").alias("file1"))
    in_template = files.groupBy("template", "clean").agg(F.max("file").alias("file2"), F.count("*").alias("n2"))
    anywhere = files.groupBy("clean").agg(F.max("file").alias("file3"), F.count("*").alias("n3"))
    found = notes.join(exact, "name", "left").join(in_template, ["template", "clean"], "left").join(anywhere, "clean", "left")
    early = F.coalesce(F.col("file1"), F.when(F.col("n2") == 1, F.col("file2")), F.when(F.col("n3") == 1, F.col("file3")))
    method = F.when(F.col("file1").isNotNull(), "exact_file_name").when(F.col("n2") == 1, "template_clean_name").when(F.col("n3") == 1, "global_clean_name")
    first = found.select("id", "template", "clean", early.alias("early"), method.alias("method"))
    left = first.filter("early is null and clean <> ''").select("id", "template", "clean")
    names = left.select(F.col("template").alias("grp"), F.col("clean").alias("text")).filter("grp is not null").distinct()
    held = files.filter("clean <> '' and template is not null").groupBy(F.col("template").alias("grp"), F.col("clean").alias("text")).agg(F.min("file").alias("low"), F.max("file").alias("high"))
    met = held_and_holding(names, held).filter("low = high").select(F.col("grp").alias("template"), F.col("text").alias("clean"), F.col("low").alias("late"))
    only = left.join(met, ["template", "clean"]).select("id", "late")
    out = first.join(only, "id", "left")
    return out.select("id", F.coalesce("early", "late").alias("file"), F.coalesce("method", F.when(F.col("late").isNotNull(), "template_clean_contains"), F.lit("unmatched")).alias("match_method"))


def last_write(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row for each key, the last in order."""
    cols = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_row")).select(key, "_row.*")


def visible_lookup(rows: DataFrame, raw: str, clean: str, value: str, order: list[str]) -> DataFrame:
    """(key, value) under raw and clean names of every row; of several rows the last counts."""
    keys = F.explode(F.array_distinct(F.array(raw, clean))).alias("key")
    return last_write(rows.select(keys, F.col(value).alias("value"), *[F.col(o) for o in order if o not in (raw, clean)]).filter("key is not null and key <> ''"), "key", [o for o in order if o not in (raw, clean)]).select("key", "value")


def fallback_lookup(df: DataFrame, lookup: DataFrame, keys: list[str], out: str) -> DataFrame:
    """The value of the first of `keys` that `lookup` (key, value) has."""
    found = [f"_v{k}" for k in range(len(keys))]
    joined = reduce(lambda d, kc: d.join(lookup.select(F.col("key").alias(kc[0]), F.col("value").alias(kc[1])), kc[0], "left"), zip(keys, found, strict=True), df)
    return joined.withColumn(out, F.coalesce(*found)).drop(*found)


def override(df: DataFrame, corrections: DataFrame, key: str, column: str, corrected: str) -> DataFrame:
    """`column` replaced where `corrections` has a value for the key."""
    right = corrections.select(key, F.col(corrected).alias("_new"))
    return df.join(right, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def unambiguous(files: DataFrame, name: str, value: str) -> DataFrame:
    """By name: files, distinct values and the value if there is just one."""
    g = files.groupBy(name).agg(F.count("*").alias("files"), F.countDistinct(value).alias("distinct_values"), F.min(value).alias("_one"))
    return g.withColumn("status", F.when(F.col("distinct_values") > 1, "ambiguous").when(F.col("distinct_values") == 1, "ok").otherwise("no date")).withColumn(value, F.when(F.col("distinct_values") == 1, F.col("_one"))).drop("_one")


def two_tier_join(left: DataFrame, files: DataFrame, name: str, value: str, fold) -> DataFrame:
    """`value` by exact name, else by folded name if that stands for one value."""
    exact = unambiguous(files, name, value).filter(F.col("status") == "ok").select(name, F.col(value).alias("_exact"))
    folded = unambiguous(files.withColumn("_fold", fold(F.col(name))), "_fold", value).filter(F.col("status") == "ok").select("_fold", F.col(value).alias("_near"))
    out = left.withColumn("_fold", fold(F.col(name))).join(exact, name, "left").join(folded, "_fold", "left")
    method = F.when(F.col("_exact").isNotNull(), "exact").when(F.col("_near").isNotNull(), "normalised").otherwise("none")
    return out.withColumns({value: F.coalesce("_exact", "_near"), "method": method}).drop("_exact", "_near", "_fold")


def longest_prefix(df: DataFrame, text: Column, prefixes: list[str], within: int = 18) -> Column:
    """The longest of `prefixes` that stands in the text and begins within its first `within` characters."""
    order = sorted(prefixes, key=lambda p: (-len(p), p))
    return F.coalesce(*[F.when((F.instr(text, p) >= 1) & (F.instr(text, p) <= within), F.lit(p)) for p in order])


def promote_header(rows: DataFrame, cells: str, ordinal: str, markers: list[str]) -> tuple[DataFrame, list[str]]:
    """The rows after the one that names most markers, and that row's cells as names; the first of equal ones."""
    score = F.size(F.array_intersect(F.transform(cells, lambda x: F.trim(x)), F.array(*[F.lit(m) for m in markers])))
    best = rows.select(F.col(ordinal).alias("o"), F.col(cells).alias("c"), score.alias("s")).orderBy(F.desc("s"), "o").first()
    names = [str(x).strip() if x else f"Column{k}" for k, x in enumerate(best["c"], 1)]
    body = rows.filter(F.col(ordinal) > best["o"]).select(ordinal, *[F.get(cells, F.lit(k)).alias(n) for k, n in enumerate(names)])
    return body, names


def complete_grid(facts: DataFrame, first: str, second: str, value: str, most: int = 100_000) -> DataFrame:
    """A row for every pair of values of two small axes, 0 where there is no fact. Axes of more pairs than `most` are an error."""
    sizes = facts.agg(F.countDistinct(first).alias("a"), F.countDistinct(second).alias("b")).first()
    if sizes.a * sizes.b > most:
        raise ValueError(f"a grid of {sizes.a} by {sizes.b} has more than {most} places")
    a = facts.agg(F.collect_set(first).alias("a")).select(F.explode("a").alias(first))
    grid = a.join(facts.agg(F.collect_set(second).alias("b"))).select(first, F.explode("b").alias(second))
    return grid.join(facts, [first, second], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def with_share(df: DataFrame, value: str, *keys: str) -> DataFrame:
    return df.withColumn("share", F.col(value) / F.sum(value).over(W.partitionBy(*keys)))
