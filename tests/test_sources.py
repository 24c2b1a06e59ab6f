import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quillspark.operators.checks import write_tests
from quillspark.operators.extraction import corner_date_author, header_dates
from quillspark.operators.lines import top_right
from quillspark.schema import RECORD
from quillspark.sources import layout, readers, sinks
from quillspark.streaming.events import daily_counts, file_stream, run_available


def test_page_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "b" / "n.txt").write_bytes(b"one\x0ctwo")
    (tmp_path / "a" / "bad.txt").write_bytes(b"\xff")
    files = readers.note_files(spark, str(tmp_path), "*.txt")
    got = sorted((r.path.rsplit("/", 1)[1], r.page_no, r.page_text, bool(r.error)) for r in readers.page_texts(files, readers.form_feed_pages).collect())
    assert got == [("bad.txt", None, None, True), ("n.txt", 1, "one", False), ("n.txt", 2, "two", False)]
    assert {r.template_folder for r in readers.indexed_folders(spark, {"AFS": str(tmp_path / "a" / "b"), "GNG": str(tmp_path)}, "*.txt").collect()} == {"AFS", "GNG"}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", you', 2.5), (2, None, None)], "note_id long, template string, words double")
    sinks.write_csv(df, str(tmp_path / "c"), sep=";", single=True)
    got = readers.csv_table(spark, str(tmp_path / "c"), RECORD, ";")
    assert sorted((r.note_id, r.template, r.words) for r in got.collect()) == [(1, 'say "hi", you', 2.5), (2, None, None)] and "HR" in got.columns


def test_unsure_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("report,,\nName,Date,Words\na,b,3\n")
    got = readers.unsure_header_table(spark, str(tmp_path / "t.csv"), ["Name", "Words"])
    assert [tuple(r) for r in got.collect()] == [("a", "b", "3")] and got.columns == ["Name", "Date", "Words"]


def test_payload_and_tables(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"meta": 1, "records": [{"a": 1}, {"a": 2}]}))
    df = readers.payload(spark, str(tmp_path / "p.json"))
    assert sorted(r.a for r in df.collect()) == [1, 2]
    sinks.write_tables({"x": df}, str(tmp_path / "t"))
    sinks.write_payload({"x": df}, str(tmp_path / "j"))
    assert spark.read.parquet(str(tmp_path / "t" / "x")).count() == spark.read.json(str(tmp_path / "j" / "x")).count() == 2
    assert sinks.markdown(df.orderBy("a")) == "| a |\n| --- |\n| 1 |\n| 2 |"
    s = sinks.serialised(spark.range(1).select(F.lit("2024-01-02").cast("date").alias("d"), F.lit(float("nan")).alias("x"))).first()
    assert (s.d, s.x) == ("2024-01-02", None)


def test_mapping(spark):
    rows = spark.createDataFrame([("PJ DIR", "pj"), ("X", None), ("NEW", "Own")], "prefix string, merge_to string")
    found, warnings = readers.prefix_mapping(rows, ["PJ"], {"A": "B"})
    assert found == {"PJ DIR": "PJ", "NEW": "Own"} and len(warnings) == 1
    assert readers.prefix_mapping(rows.limit(0), ["PJ"], {"A": "B"})[0] == {"A": "B"}


def test_stream_matches_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    src = str(tmp_path / "src")
    events.write.parquet(src)
    run_available(daily_counts(file_stream(spark, src, events)), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = {(r.day, r.event_type): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {(r.day, r.event_type): r.n for r in events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert got and all(want[k] == n for k, n in got.items()) and len(got) >= len(want) - 10


def boxes(content):
    """A fixture's pages: lines of page, x0, y0, x1, y1 and text."""
    for line in content.decode().split("\n"):
        page, x0, y0, x1, y1, text = line.split("|")
        yield layout.Box(int(page), 600.0, 800.0, float(x0), float(y0), float(x1), float(y1), text)


def test_layout_boxes(spark, tmp_path):
    (tmp_path / "n.txt").write_text("1|300|20|500|60|Luxembourg, 03.05.2024\n1|10|20|90|60|left\n2|300|20|500|60|Luxembourg, 04.05.2024")
    (tmp_path / "s.txt").write_text("1|400|90|500|99|OPS/ABCD\n1|400|30|500|60|03/05/2024\n1|400|35|500|60|03/05/2024\n1|400|700|500|720|below\n2|400|30|500|60|second")
    (tmp_path / "bad.txt").write_text("no boxes")
    found = layout.layout_boxes(readers.note_files(spark, str(tmp_path), "*.txt"), boxes).withColumn("doc_id", F.regexp_extract("path", "([^/]+)$", 1))
    assert [(r.doc_id, r.page_no, bool(r.error)) for r in found.filter("error is not null").collect()] == [("bad.txt", None, True)]
    assert [(r.page_no, r.ord, r.x0, r.text) for r in found.filter("doc_id = 'n.txt'").orderBy("page_no", "ord").collect()] == [(1, 1, 300.0, "Luxembourg, 03.05.2024"), (1, 2, 10.0, "left"), (2, 1, 300.0, "Luxembourg, 04.05.2024")]
    assert [(r.date, r.stage) for r in header_dates(found.filter("doc_id = 'n.txt'")).collect()] == [("03/05/2024", 2)]
    spans = top_right(found.filter("doc_id = 's.txt'"))
    assert [r.text for r in spans.orderBy("y0").collect()] == ["03/05/2024", "OPS/ABCD"]
    numbered = spans.withColumn("ord", F.col("y0").cast("int"))
    assert [(r.date, r.author) for r in corner_date_author(numbered).collect()] == [("03/05/2024", "OPS/ABCD")]


def test_file_facts(spark, tmp_path):
    (tmp_path / "n.txt").write_bytes(b"one\x0ctwo\x0cthree")
    (tmp_path / "bad.txt").write_bytes(b"\xff")
    decode = lambda raw: layout.Facts(len(t := raw.decode().split("\x0c")), "D:20240503101112Z", None, t)
    got = {r.path.rsplit("/", 1)[1]: r for r in layout.file_facts(readers.note_files(spark, str(tmp_path), "*.txt"), decode).collect()}
    r = got["n.txt"]
    assert (r.pages, str(r.created), r.modified, r.first_text, r.error) == (3, "2024-05-03", None, "one\ntwo", None)
    assert got["bad.txt"].pages is None and "UnicodeDecodeError" in got["bad.txt"].error
    with pytest.raises(RuntimeError, match="decoder"):
        layout.pdf_facts(b"%PDF")


def test_csv_with_byte_order_mark(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "é"', None), (2, None, dt.date(2024, 1, 2))], "id long, t string, d date")
    sinks.write_csv(df, str(tmp_path / "c"), columns=["t", "id", "d"], bom=True)
    (part,) = (tmp_path / "c").glob("part-*")
    assert part.read_bytes().startswith(b'\xef\xbb\xbf"t","id","d"\n')
    got = readers.csv_table(spark, str(tmp_path / "c"))
    assert sorted(map(tuple, got.collect()), key=str) == [('say "é"', "1", None), (None, "2", "2024-01-02")]


def test_mapping_table(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Mapping of prefixes,,\nNo,Prefix,Merge To\n1,PJ DIR,pj\n2,X,\n")
    rows = readers.mapping_table(spark, str(tmp_path / "m.csv"))
    assert readers.prefix_mapping(rows, ["PJ"], {})[0] == {"PJ DIR": "PJ"}
    with pytest.raises(ValueError, match="more than"):
        readers.prefix_mapping(spark.range(readers.MOST_PREFIXES + 1).select(F.col("id").cast("string").alias("prefix"), F.lit("x").alias("merge_to")), [], {})
    (tmp_path / "n.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no line"):
        readers.mapping_table(spark, str(tmp_path / "n.csv"))


def test_tests_written(spark, tmp_path):
    summary = spark.createDataFrame([("a", "warn", 1.0, "rows"), ("b", "pass", 0.0, "rows")], "test string, status string, metric double, unit string")
    details = spark.createDataFrame([("a", 7, "GNG", "PJ", 3.0)], "test string, note_id long, template string, department string, value double")
    write_tests(summary, details, str(tmp_path / "t"))
    got = {r.test: r for r in spark.read.json(str(tmp_path / "t" / "tests")).collect()}
    assert got["a"].rows[0].note_id == 7 and got["b"].rows is None and readers.csv_table(spark, str(tmp_path / "t" / "tests_summary")).count() == 2
