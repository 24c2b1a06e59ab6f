"""Pages and facts of files, SQL functions, table functions, samples, grouping sets, refreshes and accuracy runs."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions import sql as S
from quillspark.functions import text as X
from quillspark.functions.names import clean_key, to_ascii
from quillspark.operators import ordering as O
from quillspark.operators.extraction import extract_other
from quillspark.operators.filters import FilterState
from quillspark.operators.refresh import refresh
from quillspark.operators.summaries import kpis, overview, overview_sets
from quillspark.plans.records import records
from quillspark.sources.pages import DECODERS, note_facts, note_pages
from quillspark.sources.readers import form_feed_pages, note_files, page_texts
from quillspark.sources.registry import accuracy_run


def lines_decoder(content):
    """A decoder of another kind, as a fixture: a page for each line; text that is no UTF-8 is an error."""
    return content.decode("ascii").split("\n")


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for k in range(30):
        (tmp_path / ("a" if k % 2 else "a/b") / f"n{k:02}.pdf").write_text(f"page one of {k}\fé two\f" + "x" * k)
    (tmp_path / "a" / "broken.pdf").write_bytes(b"\xff\xfe\xfa")
    (tmp_path / "a" / "other.txt").write_text("not read")
    return str(tmp_path)


def test_pages_match_the_reader_of_whole_files(spark, folder):
    got = note_pages(spark, folder, bytes=200)
    want = page_texts(note_files(spark, folder), form_feed_pages)
    plain = lambda df: sorted(((r.path.removeprefix("file:"), r.page_no, r.page_text, r.error) for r in df.collect()), key=str)
    assert plain(got) == plain(want) and got.rdd.getNumPartitions() > 3
    assert got.filter("error is not null").count() == 1


def test_other_decoders_and_schemes(spark, folder):
    got = note_pages(spark, f"file://{folder}", "*0.pdf", decode="tests.test_surfaces:lines_decoder")
    assert {r.path for r in got.collect()} == {f"file://{folder}/a/b/n{k:02}.pdf" for k in (0, 10, 20)} and got.filter("error like 'UnicodeDecodeError%'").count() == 3


def test_facts_decode_no_text(spark, folder, monkeypatch):
    facts = {r.path.rsplit("/", 1)[1]: r for r in note_facts(spark, folder).collect()}
    assert len(facts) == 31 and facts["n07.pdf"].pages == 3 and facts["n07.pdf"].size == len("page one of 7\fé two\f".encode()) + 7
    # The count of form feeds needs no decoding, so even a file that can't be decoded has one.
    assert facts["broken.pdf"].pages == 1 and facts["broken.pdf"].error is None and isinstance(facts["n00.pdf"].modified, datetime.datetime)
    assert "form_feed" in DECODERS
    with pytest.raises(Exception, match="no such columns"):
        spark.read.format("note_pages").options(path=folder).schema("path string, author string").load().count()


def test_filters_on_paths_open_their_files_only(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        one = f"{folder}/a/n01.pdf"
        got = note_pages(spark, folder).filter(F.col("path") == one)
        assert {r.path for r in got.collect()} == {one} and got.count() == 3
        assert note_pages(spark, folder).filter(F.col("path").isin(one, f"{folder}/a/broken.pdf")).count() == 4
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_every_function_in_sql_equals_its_column(spark):
    names = S.register(spark, "q_")
    assert len(names) == len(S.FUNCTIONS)
    samples = {"string": ["GR&C - RM", " 1. Café ﬁle.PDF ", "MCGNG 123 noteMCdec 2024-01-02_x", "o a-\n b's 3/4 'q' \\d", "Luxembourg, 03.04.2024", "D:20240203", None, "- 3 -"], "double": [2.5, 0.0, None, 12.5], "date": [datetime.date(2024, 3, 4), None, datetime.date(2024, 4, 3)], "array<string>": [["", " Contents"], None, []]}
    for name, (parameters, _, build) in S.FUNCTIONS.items():
        rows = [tuple(samples[t][(k + n) % len(samples[t])] for n, t in enumerate(parameters.values())) for k in range(8)]
        df = spark.createDataFrame(rows, ", ".join(f"{p} {t}" for p, t in parameters.items())).coalesce(1)
        called = spark.sql(f"SELECT q_{name}({', '.join(parameters)}) AS v FROM {{df}}", df=df)
        assert [r.v for r in called.collect()] == [r.v for r in df.select(build(*[F.col(p) for p in parameters]).alias("v")).collect()], name
        assert "Python" not in called._jdf.queryExecution().executedPlan().toString(), name


def test_ascii_text_of_any_script(spark):
    import unicodedata

    texts = ["Café", "ﬁne ½ ⑩ ㎏ ß Å ŀ", "𝐀𝟙 plain", "日本 ñ", "", None, "ascii only\n", "\x00\x7f\x80", "éä", "ǅ Ⅷ ™"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    want = [None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert [r[0] for r in df.select(to_ascii(F.col("t"))).collect()] == want
    assert df.select(clean_key(F.lit(" 12. ﬁle-é.pdf"))).first()[0] == "FILEE"


def test_other_notes_by_table_function(spark):
    rng = random.Random(5)
    rows = []
    for doc in range(6):
        body = [f"{doc} intro words", "6 OPINIONS FROM THE SERVICES", f"6.1 PJ Opinion one two {'three ' * doc}", "Validated by SMITH John 6.2 JU Opinion fine words here", "Validated by DOE Jane", "annex"]
        rows += [(doc, k, t if doc != 3 else t.replace("OPINIONS", "none")) for k, t in enumerate(body[: 3 + doc], 1)]
    rng.shuffle(rows)
    pages = spark.createDataFrame([*rows, (9, 1, None)], "doc_id long, page_no int, page_text string")
    S.register_tables(spark)
    got = {r.doc_id: r for r in spark.sql("SELECT * FROM other_note(TABLE({pages}) PARTITION BY doc_id ORDER BY page_no)", pages=pages).collect()}
    want = {r.doc_id: r for r in extract_other(pages).collect()}
    assert set(got) == set(want) == {0, 1, 2, 3, 4, 5, 9}
    for doc, r in want.items():
        g = got[doc]
        assert (g.pages, g.pages_before, g.annex_pages, g.words, g.has_section) == (r.pages, r.pages_before, r.annex_pages, r.words, r.has_section)
        assert all(g.services.get(s) == r[s] for s in ("PJ", "JU", "RM"))


@pytest.mark.parametrize(("size", "n"), [(1, 1), (20, 20), (21, 5), (1000, 7), (5000, 2500)])
def test_sample_of_the_seeded_generator(spark, size, n):
    names = [f"note {k * 7919 % 10007:05}.pdf" for k in range(size)]
    df = spark.createDataFrame([(x, k) for k, x in enumerate(names)], "name string, k int")
    assert [r.name for r in O.seeded_sample(df, n, 20260529, "name").collect()] == sorted(random.Random(20260529).sample(sorted(names), n))
    assert [r.name for r in O.seeded_sample(df, n, 1, "name", method="first").collect()] == sorted(names)[:n]


def test_samples_that_cannot_be(spark):
    for n, message in ((0, "one row at least"), (6, "are there")):
        for method in ("random", "first"):
            with pytest.raises(ValueError, match=message):
                O.seeded_sample(spark.range(5), n, 1, "id", method=method)


def test_grouping_sets_equal_their_overviews(spark, sf_dir):
    notes = records(spark, sf_dir).withColumn("extraction", F.when(F.col("note_id") % 5 > 0, F.col("extraction")))
    got = overview_sets(notes, {"a": ["template"], "b": ["template", "extraction"], "c": ["batch"]}).collect()
    for name, keys in (("a", ["template"]), ("b", ["template", "extraction"]), ("c", ["batch"])):
        want = overview(notes, *keys)
        mine = [r for r in got if r.grouping == name]
        assert sorted(([r[c] for c in want.columns] for r in mine), key=str) == sorted((list(r) for r in want.collect()), key=str)
        assert all(r[k] is None for r in mine for k in ("template", "extraction", "batch") if k not in keys)


def test_refresh_measures_in_one_job(spark, sf_dir, tmp_path):
    notes = records(spark, sf_dir)
    state = FilterState(templates=["AFS", "OTHER"], words_from=50_000)
    executions = spark._jsparkSession.sharedState().statusStore()
    ran = executions.executionsCount()
    got = refresh(notes, state, str(tmp_path / "view"), ["note_id", "words"])
    assert executions.executionsCount() == ran + 1
    view = state.apply(notes)
    want = kpis(view, ["PJ"]).first()
    assert got.shown == want.documents == spark.read.parquet(str(tmp_path / "view")).count() and got.total == notes.count()
    assert got.measures["words_sum"] == pytest.approx(want.words_sum, abs=0.02) and (got.measures["first_date"], got.measures["last_date"]) == (want.first_date, want.last_date)
    assert got.domains["template"] == sorted(r[0] for r in notes.select("template").distinct().collect()) and got.status.startswith(f"{want.documents:,} of ")
    empty = refresh(notes, FilterState(search="nothing has this"), str(tmp_path / "none"))
    assert (empty.shown, empty.status.endswith("No dated rows")) == (0, True)


def test_accuracy_run_by_the_registry(spark):
    text = "words before here\n6. Services' acknowledgement\nPJ contribution\ngood and fine\nExpected timetable"
    pages = spark.createDataFrame([(k, 1, text + " more" * k) for k in range(40)], "doc_id long, page_no int, page_text string")
    visible = spark.createDataFrame([(k, 1, 1, 3, 5 + (k == 7)) for k in range(40)], "doc_id long, pages int, pages_before int, words int, PJ int")
    for c in ("annex_pages", "OPS", "GLO", "RM", "OCCO", "JU", "ECON", "CFC", "EIF", "FI", "IG", "PMM", "SG", "GIS", "HR", "OTHER"):
        visible = visible.withColumn(c, F.lit(None).cast("int"))
    run = accuracy_run("gng", pages, visible)
    assert run.overall.first().documents == 40
    wrong = {r.doc_id: r.mismatched for r in run.documents.collect() if r.mismatched}
    assert wrong == {7: "PJ"}
    part = accuracy_run("GNG", pages, visible, limit=6, seed=3)
    assert sorted(r.doc_id for r in part.documents.collect()) == sorted(random.Random(3).sample(range(40), 6))
    with pytest.raises(KeyError, match="unknown note type"):
        accuracy_run("XYZ", pages, visible)


def test_words_are_counted_one_way(spark):
    df = spark.createDataFrame([("well-known and/or R&D",)], "t string")
    S.register(spark)
    assert spark.sql("SELECT word_count(t) AS n FROM {df}", df=df).first().n == df.select(X.word_count(F.col("t"))).first()[0] == 3
