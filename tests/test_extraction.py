"""Note extraction on small made-up notes, one rule at a time."""

import pytest
from pyspark.sql import functions as F

from quillspark.operators import extraction as X
from quillspark.operators.lines import drop_repeats, top_right, visible_lines
from quillspark.schema import SERVICES
from quillspark.sources.registry import NoteType, dispatch


def pages(spark, *docs):
    return spark.createDataFrame([(d, p, t) for d, texts in enumerate(docs, 1) for p, t in enumerate(texts, 1)], "doc_id long, page_no int, page_text string")


def rows(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_gng(spark):
    note = [
        "Title words here\nCorporate Use\n- 1 -\nbody of a hyphen-\nated text",
        "more body\n6. Services’ acknowledgement\n1 2 3 4\nPJ contribution\nfine by us\n10 20 30 40\nPJ\nstill fine\nGR&C – RM\nrisk is low",
        "ECON\ngood Expected timetable soon\nJU\nnot counted\nGNG validation",
        "annex", None,
    ]
    got = rows(X.extract_gng(pages(spark, note, ["no section at all"], [None])))
    r = got[1]
    # Title words here / body of a hyphenated text / more body
    assert (r["pages"], r["pages_before"], r["annex_pages"], r["words"]) == (5, 2, 2, 10)
    # The first segment loses its table lines and keeps both headings; headings count.
    assert (r["PJ"], r["RM"], r["ECON"], r["JU"]) == (2 + 3 + 1 + 2, 2 + 3, 2, None)
    assert (got[2]["words"], got[2]["pages_before"], got[2]["annex_pages"], got[2]["PJ"]) == (None, None, None, None)


AFS = [
    "Table of contents\n4. Opinions\nPJ Opinion",
    "Project text before\n4. Services Opinions\nintro line",
    "A. PJ Opinion\nsounds good\nMC AFS 12\nOps position\nagreed by ops\nOutcome of OCCO assessment\nlow risk\nF.\nProject Committee\nnot this",
    "5. Timetable\nFact Sheet validation",
    "annex",
]


def test_afs(spark):
    before = ["PJ Opinion\nearly one", "Opinions\nRM/OPE input\nlate one"]
    alone = ["text\nJU\njust ju words\nTimetable\nJU\nno"]
    header = ["text\nOpinions\nnothing that counts\n1. Timetable\nPJ Opinion\nno"]
    got = rows(X.extract_afs(pages(spark, AFS, before, alone, header, ["plain text only"])))
    r = got[1]
    assert (r["mode"], r["pages"], r["pages_before"], r["annex_pages"]) == ("primary_to_first_counted", 5, 3, 1)
    # Contents pages are left out; headings of opinions don't count, the lone "F." does.
    assert (r["words"], r["PJ"], r["OPS"], r["OCCO"]) == (3 + 3 + 2, 2, 3, 3)
    assert (got[2]["mode"], got[2]["RM"], got[2]["PJ"]) == ("fallback_then_primary_to_first_counted", 2, None)
    assert (got[3]["mode"], got[3]["JU"], got[3]["words"]) == ("fallback_counted_prefix", 3, 1)
    assert (got[4]["mode"], got[4]["PJ"], got[4]["pages_before"]) == ("primary_no_counted_prefix", None, 1)
    assert (got[5]["mode"], got[5]["words"], got[5]["pages_before"]) == (None, 3, None)


FILL = "word " * 20


def test_other(spark):
    note = [
        "Intro it's here",
        f"6 OPINIONS FROM THE SERVICES\n6.1 Unknown Opinion\n{FILL}\n6.2 GR&C-RM\nOpinion {FILL} Validated by SMITH John\n{FILL}6.3 PJ Opinion\nok Validated by DOE",
        f"{FILL} 6.4 JU Opinion two words Validated by ROE Ann\nafter",
        "annex Validated by LATE Person",
    ]
    unfinished = ["OPINIONS FROM THE SERVICES 6.1 PJ Opinion some words and no end", "more"]
    plain = ["body text", "Validated by someone special At 01/02/2024 10:30", "annex"]
    got = rows(X.extract_other(pages(spark, note, unfinished, plain, [None])))
    r = got[1]
    assert (r["words"], r["pages_before"], r["annex_pages"]) == (3, 2, 1)
    # One word is no opinion; a header cut by a line end counts on squeezed text.
    assert (r["RM"], r["PJ"], r["JU"]) == (20, None, 2)
    assert (got[2]["has_section"], got[2]["PJ"], got[2]["annex_pages"], got[2]["words"]) == (True, None, None, 0)
    assert (got[3]["has_section"], got[3]["pages_before"], got[3]["annex_pages"], got[3]["words"]) == (False, 2, 1, 2 + 10)
    assert got[4]["words"] == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [("none", {}), (f"OPINIONS FROM THE SERVICES 1.1 PJ Opinion {FILL} Validated by XX 1.2 PJ Opinion c d Validated by YY", {"PJ": 22}), ("OPINIONS FROM THE SERVICES 1.1 some very long header before PJ Opinion a b Validated by XX", {})],
)
def test_scan(text, want):
    assert X.opinions_of(text, X.OTHER_GROUPS).words == want


def test_header_dates(spark):
    cols = "doc_id long, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, text string, ord int"
    at = lambda d, x, y, text, o: (d, 1, 600.0, 800.0, float(x), float(y), float(x + 100), float(y + 10), text, o)
    blocks = [
        at(1, 300, 10, "Luxembourg, 01/01/2024", 1), at(1, 300, 200, "Corporate Use\nx\nLuxembourg 02.02.2024", 2),
        at(2, 300, 90, "Luxembourg, 04/04/2024", 1), at(2, 300, 50, "Luxembourg, 03/03/2024", 2),
        at(3, 10, 700, "Luxembourg, 05/05/2024", 1), at(4, 300, 10, "01/01/2024", 1),
    ]
    got = {r.doc_id: (r.date, r.stage) for r in X.header_dates(spark.createDataFrame(blocks, cols)).collect()}
    assert got == {1: ("02/02/2024", 1), 2: ("03/03/2024", 2), 3: ("05/05/2024", 3)}


def test_lines_from_words(spark):
    words = [(1, 1, 0, 0, 50.0, 10.0, 60.0, 20.0, "world"), (1, 1, 0, 0, 10.0, 10.0, 40.0, 20.0, "hello"), (1, 1, 0, 1, 10.0, 30.0, 20.0, 40.0, "next")]
    got = visible_lines(spark.createDataFrame(words, "doc_id long, page_no int, block int, line int, x0 double, y0 double, x1 double, y1 double, word string")).orderBy("ord").collect()
    assert [(r.text, r.ord, r.x1) for r in got] == [("hello world", 1, 60.0), ("next", 2, 20.0)]
    lines = spark.createDataFrame([(1, 1, 100.0, 100.0, 60.0, 1.0, 90.0, "A"), (1, 1, 100.0, 100.0, 60.0, 2.0, 90.0, "A"), (1, 1, 100.0, 100.0, 1.0, 3.0, 20.0, "left"), (1, 2, 100.0, 100.0, 60.0, 1.0, 90.0, "B")], "doc_id long, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, text string")
    assert [r.text for r in top_right(lines).collect()] == ["A"]
    assert drop_repeats(lines, "text", "doc_id", "page_no", "y0").count() == 3


def test_authors(spark):
    got = {r.doc_id: r.author for r in X.author_after_date(X.page_lines(pages(spark, ["OPS/EARLY\n01/02/2024\nsome line\nOPS/LATE", "x"], ["no date\nOPS/X"]))).collect()}
    assert got == {1: "OPS/LATE"}
    lines = spark.createDataFrame([(1, 1, "2024-03-01"), (1, 2, "SG/FIRST"), (1, 3, "on 05/04/2024"), (1, 4, "20241234"), (1, 5, "PJ/AFTER-1"), (2, 1, "2024-02-30"), (2, 2, "ECON-DIV"), (3, 1, "IG/ALONE")], "doc_id long, ord int, text string")
    assert {r.doc_id: (r.date, r.author) for r in X.corner_date_author(lines).collect()} == {1: ("05/04/2024", "PJ/AFTER-1"), 2: (None, "ECON-DIV"), 3: (None, "IG/ALONE")}


def test_header_dates_read_whole_pages(spark, sf_dir, monkeypatch):
    from quillspark.plans import extraction_plans

    monkeypatch.setattr(extraction_plans.X, "header_dates", lambda blocks: blocks)
    texts = {r.doc_id: r.text for r in extraction_plans.header_date_stages(spark, sf_dir).collect()}
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(texts) == len(pages) and all(texts[k].endswith(v) for k, v in pages.items())


def test_provenance(spark):
    note = ["front page", "intro\n6. Services’ acknowledgement\n- 2 -\nPJ contribution\nfine\nPJ\nstill\nECON\n3 of 9\ngood Expected timetable", "after\nPJ"]
    got = rows(X.gng_provenance(pages(spark, note, ["no section"])))
    r = got[1]
    assert (r["section_found"], r["section_text"], r["section_page"], r["stop_text"]) == (True, "6. Services' acknowledgement", 2, "Expected timetable")
    assert [(x.line, x.reason) for x in r["removed"]] == [("- 2 -", "page number"), ("3 of 9", "x of y page marker")]
    assert [(x.prefix, x.accepted) for x in r["headings"]] == [("PJ", True), ("PJ", False), ("ECON", True)]
    assert (got[2]["section_found"], got[2]["removed"], got[2]["headings"]) == (False, [], [])


def test_output_rows(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "doc_id long, has_section boolean").select("doc_id", "has_section", *[F.lit(5 if s == "PJ" else 0).alias(s) for s in SERVICES])
    got = {r.doc_id: (r.PJ, r.RM) for r in X.output_rows(df, "has_section").collect()}
    assert got == {1: ("5", ""), 2: ("N/A", "N/A")} and X.output_rows(df).filter("RM = ''").count() == 2


def test_dispatch(spark):
    p = pages(spark, ["text only"])
    assert dispatch("gng", p).first().template == "GNG" and dispatch("Other", p).first().template == "OTHER"
    with pytest.raises(KeyError, match="AFS, GNG, OTHER"):
        dispatch("PIN", p)
    with pytest.raises(ValueError, match="not enabled: later"):
        dispatch("PIN", p, {"PIN": NoteType(X.extract_gng, "pin", enabled=False, notes="later")})


def test_provenance_of_afs_notes(spark):
    got = rows(X.afs_provenance(pages(spark, AFS, ["plain text only"], ["text\nJU\njust ju words\n\n- 2 -\nConfidential\nTimetable\nJU\nno"])))
    r = got[1]
    assert (r["mode"], r["start_text"], r["start_page"], r["stop_text"]) == ("primary_to_first_counted", "A. PJ Opinion", 3, "Project Committee")
    # The contents page names an opinion that doesn't count; the footer is left out.
    assert [(h["prefix"], h["accepted"]) for h in r["headings"]] == [("PJ", False), ("PJ", True), ("OPS", True), ("OCCO", True)]
    assert [(x["line"], x["reason"]) for x in r["removed"]] == [("MC AFS 12", "MC AFS footer")]
    assert (got[2]["mode"], got[2]["removed"], got[2]["headings"], got[2]["stop_text"]) == (None, [], [], None)
    assert [x["reason"] for x in got[3]["removed"]] == ["blank line", "page number", "Confidential footer/header"]
    assert [(h["prefix"], h["accepted"]) for h in got[3]["headings"]] == [("JU", True), ("JU", False)]


def test_provenance_of_other_notes(spark):
    note = ["6 OPINIONS FROM THE SERVICES 6.1 Unknown Opinion", FILL * 5, "6.2 PJ Opinion one Validated by SMITH John", FILL * 5, "6.3 JU Opinion two words Validated by ROE Ann", FILL * 5, "6.4 ECON Opinion no end"]
    got = rows(X.other_provenance(pages(spark, note, ["nothing"])))
    seen = [(h["service"], h["closing"], h["words"], h["accepted"]) for h in got[1]["headers"]]
    assert seen == [(None, None, None, False), ("PJ", "Validated by SMITH John", 1, False), ("JU", "Validated by ROE Ann", 2, True), ("ECON", None, None, False)]
    assert got[1]["title"] == "6 OPINIONS FROM THE SERVICES" and (got[2]["title"], got[2]["headers"]) == (None, [])


def test_where_annexes_begin(spark):
    got = rows(X.annex_provenance(pages(spark, AFS, ["Fact Sheet validation\n5. Timetable"], ["fact sheet validation"]), "AFS"))
    assert [(d, r["annex_text"], r["annex_page"], r["after"] is not None) for d, r in sorted(got.items())] == [(1, "Fact Sheet validation", 4, True), (3, "fact sheet validation", 1, False)]
    gng = rows(X.annex_provenance(pages(spark, ["Expected timetable", "GNG validation"], ["GNG validation"]), "GNG"))
    assert {d: (r["annex_text"], r["annex_page"]) for d, r in gng.items()} == {1: ("GNG validation", 2)}


def test_provenance_of_header_dates(spark):
    blocks = [(1, 1, 600.0, 800.0, 300.0, 20.0, 500.0, 60.0, "x\nLuxembourg, 01.02.2024 ref", 1), (1, 1, 600.0, 800.0, 10.0, 700.0, 90.0, 720.0, "Luxembourg 03/04/2020", 2)]
    r = X.header_date_provenance(spark.createDataFrame(blocks, "doc_id int, page_no int, page_w double, page_h double, x0 double, y0 double, x1 double, y1 double, text string, ord int")).first()
    assert (r.date, r.stage, r.trigger, r.page_no, r.x0, r.y0, r.candidates) == ("01/02/2024", 2, "Luxembourg, 01.02.2024 ref", 1, 300.0, 20.0, 2)
