"""Semantics that are easy to get wrong: nulls, first rows, ties, edges of bins, rounding."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.functions.dates import date_status, day_month_year, filename_date, meta_date, parse_date, path_year, swapped, visible_date
from quillspark.functions.names import clean_key, repair_mojibake
from quillspark.functions.stats import axis_maximum, null0, percent, safe_ratio
from quillspark.operators import accuracy as A
from quillspark.operators import checks, inference, joins, ordering, summaries, trends
from quillspark.operators.derive import derive, product_label, template_label, timeline_date
from quillspark.operators.filters import FilterState, date_range, matches
from quillspark.operators.services import without_pin
from quillspark.schema import RECORD, coerce, select_existing, with_missing_columns

D = dt.date


def one(spark, column, **values):
    kinds = {str: "string", float: "double", int: "long", D: "date", bool: "boolean", type(None): "string"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) if values else "x int")
    return df.select(column.alias("r")).first().r


@pytest.fixture(scope="module")
def notes(spark):
    base = dict(template=" other ", extraction="Manual", batch="B1", file_name="f.pdf", product=" ", author=None, process=None, validation_date=D(2024, 1, 31), bo_date=D(2024, 1, 1), words=100.0, pages=0.0, pages_before=None, annex_pages=1.0)
    rows = [
        base | dict(note_id=1, PJ=5.0, RM=0.0), base | dict(note_id=2, template="AFS", words=None, pages=4.0, validation_date=None, bo_date=None, PJ=None, RM=None),
        base | dict(note_id=3, template="GNG", words=300.0, pages=2.0, validation_date=D(2026, 6, 3), PJ=400.0, RM=1.0, author="A"), base | dict(note_id=4, template=None, words=50.0, author="A"),
    ]
    df = spark.createDataFrame([tuple(r.get(f.name) for f in RECORD) for r in rows], RECORD)
    return derive(df).cache()


def test_null_families(spark, notes):
    r = notes.agg(F.avg("words").alias("skip"), F.avg(null0(F.col("words"))).alias("zero")).first()
    assert (r.skip, r.zero) == (150.0, 112.5)


def test_derived_columns(notes):
    r = {x.note_id: x for x in notes.collect()}
    assert (r[1].template, r[1].product, r[1].words_per_page, r[1].words_per_pre_page) == ("OTHER", "Missing product", None, None)
    assert (r[1].service_words, r[1].service_sections, r[2].service_words) == (5.0, 1, 0.0)
    assert (r[1].month, r[1].quarter, r[1].delta_days, r[2].delta_days) == (D(2024, 1, 1), "2024 Q1", -30, None)
    assert (r[3].is_future, r[2].is_future, r[2].has_date, r[4].template) == (True, False, False, None)


def test_labels_keep_null(spark):
    df = spark.createDataFrame([(None,), (" a ",), ("",)], "c string")
    assert [x.t for x in df.select(template_label(F.col("c")).alias("t")).collect()] == [None, "A", ""]
    assert [x.t for x in df.select(product_label(F.col("c")).alias("t")).collect()] == ["Missing product", "a", "Missing product"]
    assert one(spark, timeline_date(F.col("d")), d=D(2000, 1, 1)) is None


def test_null_keys_join_and_first_row_wins(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, k long")
    right = spark.createDataFrame([(10, "late", 2), (10, "first", 1), (None, "none", 3)], "key long, v string, o int")
    got = {r.id: r.v for r in joins.null_safe_left_join(left, right, "k", "key", "o").collect()}
    assert got == {1: "first", 2: "none", 3: None}


def test_groups_keep_null_keys_where_asked(notes):
    assert {r.template for r in summaries.overview(notes, "template").collect()} == {"OTHER", "AFS", "GNG", None}
    assert {r.author for r in summaries.authors(notes, 1).collect()} == {"A"}


def test_rounding_and_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    r = df.agg(F.percentile("x", 0.25).alias("q"), F.bround(F.lit(2.5), 0).alias("even"), F.round(F.lit(2.5), 0).alias("up"), F.stddev_samp(F.lit(None).cast("double")).alias("s")).first()
    assert (r.q, r.even, r.up, r.s) == (1.5, 2.0, 3.0, None)
    assert df.limit(1).agg(F.stddev_samp("x")).first()[0] is None


def test_correlation_is_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 5.0), (4.0, None, 2.0)], "a double, b double, c double")
    got = {(r["left"], r["right"]): r["corr"] for r in summaries.correlations(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == round(float(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1]), 4) and got["a", "a"] == 1.0


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", "a"), ("g", None)], "k string, v string")
    assert summaries.mode_by_group(df, ["k"], "v", "m").first().m == "a"


def test_period_edges(spark, notes):
    rows = [(D(2020, 12, 31),), (D(2021, 1, 1),), (D(2017, 12, 31),)]
    df = spark.createDataFrame([(d, "T", 1.0, 1.0, 1.0) for (d,) in rows], "validation_date date, template string, words double, pages double, service_words double")
    assert {r.period: r.documents for r in trends.period_bins(df, trends.PERIODS).collect()} == {"2018-2020": 1, "2021-2022": 1}


def test_rolling_counts_present_rows(spark):
    df = spark.createDataFrame([("T", D(2024, m, 1), v) for m, v in ((1, 1.0), (5, 3.0), (6, None), (9, 5.0))], "template string, month date, x double")
    got = [r.r for r in trends.rolling(df, "x", "r").orderBy("month").collect()]
    assert got == [None, 2.0, 2.0, 4.0]


def test_date_filters_are_asymmetric(notes):
    ids = lambda ps: sorted(r.note_id for r in notes.filter(ps[0]).collect())
    assert ids(date_range("2024-01-01", None)) == [1, 3, 4] and ids(date_range(None, "2024-12-31")) == [1, 2, 4]


def test_filters(notes):
    ids = lambda s: sorted(r.note_id for r in s.apply(notes.withColumns({c: F.lit(None).cast("string") for c in ("team_pj", "team_rm", "team_ju")})).collect())
    assert ids(FilterState()) == [1, 2, 3]
    assert ids(FilterState(service="PJ", floor=5.0)) == [3] and ids(FilterState(search="GNG")) == [3] and ids(FilterState(only_issues=True)) == [2, 3] and ids(FilterState(only_opinions=True, floor=1.0)) == [1, 3]


def test_search_keeps_nulls_apart(spark):
    df = spark.createDataFrame([("ab", None, "cd")], "a string, b string, c string")
    assert df.filter(matches("ab  cd", ["a", "b", "c"])).count() == 1 and df.filter(matches("ab cd", ["a", "b", "c"])).count() == 0


def test_no_delta_is_a_bucket_of_its_own(notes):
    assert {r.bucket: r.documents for r in summaries.bo_delta_histogram(notes).collect()} == {"1-30 days before": 2, "No date": 1, "Over 30 days before": 1}


def test_words_in_two_ways(spark):
    t = "l'été œuvre don't x_y 12"
    assert one(spark, X.word_count(F.col("t")), t=t) == 6 and one(spark, X.ascii_word_count(F.col("t")), t="don't a-b c") == 4


def test_nan_is_null(spark):
    df = coerce(spark.createDataFrame([(1, float("nan")), (2, 1.0)], "note_id int, words double"), RECORD)
    assert df.agg(F.count("words")).first()[0] == 1
    bad = coerce(spark.createDataFrame([("x", "check"), ("7", "8")], "note_id string, words string"), RECORD).collect()
    assert [(r.note_id, r.words) for r in bad] == [(None, None), (7, 8.0)]


def test_schema_helpers(spark):
    df = with_missing_columns(spark.createDataFrame([(1,)], "note_id long"), RECORD)
    assert len(df.columns) == len(RECORD) and select_existing(df, ["words", "nope"]).columns[0] == "words"


def test_dates(spark):
    f = F.col("t")
    assert one(spark, parse_date(f), t="31.02.2020") is None and one(spark, day_month_year(f), t="2024-03-09") == "09/03/2024"
    assert one(spark, filename_date(f), t="a_2024-13-01") is None and one(spark, filename_date(f), t="n2024_05-06x") == D(2024, 5, 6)
    assert one(spark, meta_date(f), t="D:20240229120000") == D(2024, 2, 29)
    assert one(spark, visible_date(f), t="ref 01/02/2023\nLuxembourg, 3.4.2024") == D(2024, 4, 3) and one(spark, visible_date(f), t="on 1/2/2023") == D(2023, 2, 1)
    assert one(spark, path_year(f), t="/a/2024/b.pdf") == 2024
    assert one(spark, swapped(F.col("d")), d=D(2024, 3, 5)) == D(2024, 5, 3) and one(spark, swapped(F.col("d")), d=D(2024, 3, 13)) is None


def test_date_status_order(spark):
    rows = [(None, None, None), (D(2024, 1, 2), None, None), (D(2024, 1, 2), D(2024, 1, 2), None), (D(2024, 1, 2), D(2024, 2, 1), None), (D(2024, 1, 5), D(2024, 3, 9), D(2024, 1, 5)), (D(2024, 1, 5), D(2024, 3, 9), D(2024, 3, 9)), (D(2024, 1, 5), D(2024, 3, 9), None)]
    got = [r[0] for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a date, b date, c date").orderBy("k").select(date_status(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["missing_db_date", "no_visible_date", "db_matches_visible", "db_is_visible_day_month_swap", "db_matches_filename_not_visible", "visible_matches_filename_db_differs", "db_visible_mismatch"]


def test_names(spark):
    assert one(spark, clean_key(F.col("t")), t="12. Café Ünion.pdf") == "CAFEUNION"
    assert one(spark, repair_mojibake(F.col("t")), t="Ã©tÃ© donâ€™t") == "été don’t" and one(spark, repair_mojibake(F.col("t")), t="plain") == "plain"


def test_numbers(spark):
    assert one(spark, safe_ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None and one(spark, percent(F.col("a"), F.col("b")), a=1.0, b=0.0) == 0.0
    assert [one(spark, axis_maximum(F.col("a")), a=v) for v in (0.0, 7.0, 23.0, 1900.0)] == [1.0, 10.0, 25.0, 2000.0]


def test_text_scalars(spark):
    f = F.col("t")
    number = lambda name, text, t: one(spark, X.operation_number(f, F.lit(text), t), t=name)
    assert number("MCGNG 123 2023-4567", "", "GNG") == "123" and number("MC 2023-4567 x", "", "GNG") == "20234567" and number("none", "see 20241234.", "AFS") == "20241234"
    assert number("a12345678", "", "AFS") is None and number("x 2023-45678", "", "OTHER") == "202345678" and number("", " " * 4000 + "20231234", "OTHER") is None
    assert one(spark, X.note_type(f), t="2024-01-01 noteMCdec x.pdf") == "NOTEMCDEC" and one(spark, X.note_type(f), t="x") is None
    assert one(spark, X.export_prefix(X.canonical_prefix(f)), t="gr & c / rm") == "RM"
    lines = ("", " - 12 - ", "Page 2 of 9", "MC_GNG 4", "Corporate Use", "12", "Corporate Use only", "text here")
    assert [one(spark, X.noise_reason(f, "GNG"), t=v) for v in lines] == ["blank line", "page number", "x of y page marker", "MC_GNG footer", "Corporate Use footer", None, None, None]
    assert [one(spark, X.noise_reason(f, "AFS"), t=v) for v in ("MC AFS 1", "is Confidential.", "for corporate use only", "MC_GNG")] == ["MC AFS footer", "Confidential footer/header", "Corporate Use footer", None]
    assert [one(spark, X.is_table_line(f), t=v) for v in ("1,000 2.5 30% x", "1 2 x y", "-5 (12) 3 4", "1 2 3", "1 2 3 -4")] == [True, False, False, False, True]
    assert [one(spark, X.short_label(f, 6), t=v) for v in ("longer", "longest", None)] == ["longer", "longe...", "Missi..."]
    assert [one(spark, X.value_label(F.col("x"), s), x=v) for v, s in ((3.26, ""), (12.6, ""), (3.26, "%"), (4.0, "d"))] == ["3.3", "13", "3%", "4d"]
    assert one(spark, X.thousands(F.col("x"), 1), x=12345.67) == "12,345.7" and one(spark, X.html_text(f), t="<a href='x'>&") == "&lt;a href=&#39;x&#39;&gt;&amp;"
    assert one(spark, X.is_contents(F.split(f, "\n")), t="\n".join(["x"] * 10 + ["Contents"])) is False
    assert one(spark, X.division_author(f), t="OPS A/DIV‐1") == "OPS A/DIV-1" and one(spark, X.division_author(f), t="no slash") is None
    assert one(spark, X.service_author(f), t="SG/ABC//2024-12 ") == "SG/ABC" and one(spark, X.service_author(f), t="plain words") is None and one(spark, X.service_author(f), t="Corporate use/x") is None
    assert one(spark, X.label(f, {"a": "Alpha"}), t="a") == "Alpha" and one(spark, X.label(f, {"a": "Alpha"}), t="b") == "b"


def test_match_cascade_tiers(spark):
    notes = spark.createDataFrame([(1, "T", "a.pdf", "A"), (2, "T", "x", "BETAONE"), (3, "T", "x", "GAMMAONE"), (4, "T", "x", "DELTANOTE"), (5, "T", "x", "TWICE"), (6, "T", "x", ""), (7, "T", "x", "LONGERNAME")], "id int, template string, name string, clean string")
    files = spark.createDataFrame([(1, "U", "a.pdf", "Q", 1), (2, "U", "a.pdf", "R", 2), (3, "T", "b", "BETAONE", 3), (4, "U", "c", "GAMMAONE", 4), (5, "T", "d", "12DELTANOTEX", 5), (6, "T", "e", "TWICE", 6), (7, "T", "f", "TWICE", 7), (8, "T", "g", "NGERNA", 8)], "file int, template string, name string, clean string, ordinal int")
    got = {r.id: (r.file, r.match_method) for r in joins.match_cascade(notes, files).collect()}
    assert got == {1: (2, "exact_file_name"), 2: (3, "template_clean_name"), 3: (4, "global_clean_name"), 4: (5, "template_clean_contains"), 5: (None, "unmatched"), 6: (None, "unmatched"), 7: (8, "template_clean_contains")}


def test_match_cascade_short_names(spark):
    names = ["PIN", "XPINX", "MEMOONE", "NOTETWO", "AB", "ZZ", "NO", "É1", "SHORTY", ""]
    theirs = ["12PINNOTE", "MEM", "NOTETWOB", "TET", "ABC", "QABQ", "É", "HORT", "1É1", "SHO"]
    notes = [(i, "T", f"n{i}", c) for i, c in enumerate(names)] + [(100, "U", "n", "PIN")]
    files = [(i, "T", f"f{i}", c, i) for i, c in enumerate(theirs)] + [(50, "U", "f", "LONGPINNAME", 50)]
    fits = {i: [f for f, u, _, d, _ in files if u == t and c and d and (c in d or d in c)] for i, t, _, c in notes}
    got = joins.match_cascade(spark.createDataFrame(notes, "id int, template string, name string, clean string"), spark.createDataFrame(files, "file int, template string, name string, clean string, ordinal int"))
    got = {r.id: (r.file, r.match_method) for r in got.collect()}
    assert got == {i: (f[0], "template_clean_contains") if len(f) == 1 else (None, "unmatched") for i, f in fits.items()}
    assert got[0] == (0, "template_clean_contains") and got[3] == (None, "unmatched") and len(fits[3]) == 2


def test_header_promotion(spark):
    df = spark.createDataFrame([(0, ["t", None]), (1, ["Name", " Date "]), (2, ["n", "d"]), (3, ["Name", "Date"])], "o int, c array<string>")
    body, names = joins.promote_header(df, "c", "o", ["Name", "Date"])
    assert names == ["Name", "Date"] and [tuple(r) for r in body.orderBy("o").collect()] == [(2, "n", "d"), (3, "Name", "Date")]


def test_comparison(spark):
    rows = [("n", "12", "12.0"), ("b", None, "None"), ("c", "check", "3"), ("d", "03/04/2026", "03.04.2026"), ("z", "1", "0"), ("s", "a  b", " a b ")]
    got = {r.field: r for r in A.compare(spark.createDataFrame([(1, *r) for r in rows], "doc int, field string, script_value string, actual_value string"), ["d"]).collect()}
    assert [got[k].status for k in "nbcdzs"] == ["match", "both blank", "mismatch", "match", "mismatch", "match"]
    assert (got["z"].delta, got["z"].pct_delta, got["n"].delta) == (1.0, None, 0.0)


def test_ranks_over_partitions(spark):
    df = spark.createDataFrame([((k * 37) % 1000,) for k in range(1000)], "v int").repartition(7)
    assert [r["rank"] for r in ordering.ranked(df, F.col("v")).orderBy("v").collect()] == list(range(1, 1001))
    assert [r.v for r in ordering.page(df, 99, 300, F.col("v")).collect()] == list(range(900, 1000))


def test_data_tests(notes):
    services = ["PJ", "RM", "SG"]
    got = {r.test: (r.metric, r.status, r.unit) for r in checks.test_summary(notes, services, ["PJ"]).collect()}
    assert got == {
        "gng-unexpected-departments": (1, "warn", "rows"), "gng-pj-coverage": (100, "pass", "% rows positive"), "single-department-exceeds-total": (1, "warn", "rows"), "department-total-ratio": (1, "warn", "rows"),
        "future-validation-dates": (1, "warn", "rows"), "missing-validation-dates": (1, "warn", "rows"), "missing-ged-status": (4, "info", "rows"), "missing-bo-validation-dates": (1, "warn", "rows"),
        "word-count-iqr-outliers": (0, "info", "rows"), "manual-automated-median-difference": (0, "info", "templates"), "sg-template-distribution": (0, "pass", "rows"),
    }
    assert [r.note_id for r in checks.exceeds_total(notes, ["PJ", "RM"]).collect()] == [3] and [r.note_id for r in checks.high_ratio(notes).collect()] == [3]
    assert {r.test: r.metric for r in checks.test_summary(notes.limit(0), services, ["PJ"]).collect()}["gng-pj-coverage"] == 0


def test_quality_flags(notes):
    assert sorted((r.flag, r.note_id) for r in summaries.quality_flags(notes.withColumn("annex_pages", F.when(F.col("note_id") == 4, None).otherwise(1.0))).collect()) == [
        ("Future validation date", 3), ("Missing BO validation date", 2), ("Missing annex page count", 4), ("Missing validation date", 2),
    ]
    assert {r.flag: r.n for r in summaries.quality_flag_counts(notes).collect()} == {"Missing date": 1, "Future date": 1, "Missing BO date": 1}


def test_filter_state():
    state = FilterState(templates=["GNG", "OLD"], product="gone", date_from="2024-01-01", floor=5.0, search=" x ", hide_future=True)
    assert state.summary() == "Template: GNG, OLD | Product: gone | Date: 2024-01-01 to ... | Search: x | Future dates hidden | Opinion floor: > 5 words"
    back = FilterState.restored(state.snapshot() | {"unknown": 1}, {"templates": ["GNG", "AFS"], "product": ["kept"]})
    assert (back.templates, back.product, back.floor, back.hide_future) == (["GNG"], None, 5.0, True)
    assert back.reset() == FilterState() and FilterState().summary() == "All records"


def test_filters_on_status_and_future(notes):
    assert [r.note_id for r in FilterState(hide_future=True).apply(notes).orderBy("note_id").collect()] == [1, 2]
    assert FilterState(ged="Missing GED status").apply(notes).count() == 3 and FilterState(ged="Matched").apply(notes).count() == 0
    assert [r.note_id for r in FilterState(bo_from="2024-01-01").apply(notes).orderBy("note_id").collect()] == [1, 3]


def test_chosen_metrics(notes):
    assert {r.template: r.value for r in trends.trend_of(notes, "annex_pages", family=trends.PAGE_METRICS).collect()} == {"OTHER": 1.0, "GNG": 1.0, None: 1.0}
    assert {r.label for r in trends.trend_of(notes, "nothing known").collect()} == {"Mean Pages"}
    assert sorted(str(r.template) for r in without_pin(notes.withColumn("template", F.when(F.col("note_id") == 1, "PIN").otherwise(F.col("template")))).collect()) == ["AFS", "GNG", "None"]


def histogram(x, y):
    values = np.unique(np.concatenate([x, y]))
    return values, *(np.array([(v == z).sum() for v in values]) for z in (x, y))


def test_resampling():
    rng = np.random.default_rng(0)
    x, y = rng.normal(0, 1, 200), rng.normal(1, 1, 201)
    low, high = inference.bootstrap_interval(*histogram(x, y))
    plain = [np.median(rng.choice(y, 201)) - np.median(rng.choice(x, 200)) for _ in range(3000)]
    assert low < np.median(y) - np.median(x) < high and abs(low - np.quantile(plain, 0.025)) < 0.06 and abs(high - np.quantile(plain, 0.975)) < 0.06
    assert inference.permutation_p(*histogram(x, y), 500) < 0.01
    assert math.isnan(inference.bootstrap_interval(*histogram(x[:4], y))[0]) and math.isnan(inference.permutation_p(*histogram(x, y[:4])))


@pytest.mark.parametrize("sizes", [(8, 9), (12, 8), (7, 7), (30, 6)])
def test_permutation_against_every_relabelling(sizes):
    """Ties included: the share of all, or of very many, relabellings whose medians differ as much."""
    n, m = sizes
    rng = np.random.default_rng(n)
    x, y = rng.integers(0, 12, n).astype(float), rng.integers(3, 16, m).astype(float)
    seen, pooled = abs(np.median(y) - np.median(x)), np.concatenate([x, y])
    if math.comb(n + m, n) < 30_000:
        deals = [list(c) for c in itertools.combinations(range(n + m), n)]
    else:
        deals = [rng.permutation(n + m)[:n].tolist() for _ in range(30_000)]
    hits = sum(abs(np.median(np.delete(pooled, c)) - np.median(pooled[c])) >= seen for c in deals)
    assert abs(inference.permutation_p(*histogram(x, y), 20_000) - hits / len(deals)) < 0.015


def test_year_tests_find_a_shift(spark):
    rng = np.random.default_rng(2)
    rows = [("GNG", year, float(v), None) for year, shift in ((1, 0), (2, 50)) for v in rng.integers(0, 100, 400) + shift] + [("AFS", 1, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "template string, year int, words double, pages double")
    got = {(r.template, r.metric): r for r in inference.year_tests(df, ["words", "pages"], 1, 2, 500).collect()}
    r = got["GNG", "words"]
    assert (r.n_before, r.n_after) == (400, 400) and r.ci_low > 0 and r.p < 0.01 and r.difference == r.median_after - r.median_before
    assert set(got) == {("GNG", "words"), ("AFS", "words"), ("AFS", "pages")} and got["AFS", "words"].p is None
    assert [x.metric for x in inference.significant(inference.year_tests(df, ["words", "pages"], 1, 2, 500)).collect()] == ["words"]


def test_erf(spark):
    df = spark.createDataFrame([(v,) for v in (-7.0, -1.5, 0.0, 1e-3, 0.5, 2.0, 5.9, 30.0)], "x double")
    assert all(abs(r.y - math.erf(r.x)) < 1e-9 for r in df.select("x", inference.erf(F.col("x")).alias("y")).collect())


def test_intervals(spark):
    df = spark.createDataFrame([Row(k="a", value=1.0), Row(k="a", value=3.0), Row(k="one", value=5.0), Row(k="same", value=2.0), Row(k="same", value=2.0)])
    got = {r.k: r for r in inference.with_p(inference.metric_intervals(df, ["k"])).collect()}
    assert (got["one"].lower, got["one"].upper, got["one"].p, got["same"].p) == (5.0, 5.0, 1.0, 0.0)
    se = math.sqrt(2) / math.sqrt(2)
    assert got["a"].lower == round(2 - 1.96 * se, 4) and abs(got["a"].p - (1 - math.erf(2 / se / math.sqrt(2)))) < 1e-12


def test_order_of_rows_does_not_matter(notes):
    a = [tuple(r) for r in summaries.overview(notes, "template").orderBy("template").collect()]
    b = [tuple(r) for r in summaries.overview(notes.repartition(5).orderBy(F.desc("note_id")), "template").orderBy("template").collect()]
    assert a == b
