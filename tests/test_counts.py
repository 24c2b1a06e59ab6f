"""How notes count words, know contents pages and show numbers."""

from pyspark.sql import functions as F

from quillspark.functions import text as X

TEXTS = [
    ("well-known and/or R&D", 3),
    ("GR&C/OCCO", 1),
    ("ï‚· first item", 2),
    ("o first\n  O second\nother", 3),
    ("a cut-\n  word and an en–dash", 5),
    ("soft­hyphen zero​width fixed", 3),
    ("l’été d'œuvre", 2),
    ("", 0),
    (None, None),
    ("o", 1),
    ("x o y", 3),
]


def test_words_of_notes(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "t string")
    assert [(r.t, r.n) for r in df.select("t", X.word_count(F.col("t")).alias("n")).collect()] == TEXTS


def test_bullets_differ_by_template(spark):
    df = spark.createDataFrame([("• point one\n•two",)], "t string")
    assert df.select(X.flatten(F.col("t")), X.flatten(F.col("t"), "AFS")).first()[:] == ("• point one •two", "point one •two")


def test_contents_pages(spark):
    pages = [("Contents ..... 2", True), ("1. Table of contents", True), ("\n" * 12 + "CONTENTS", True), ("x\n" * 9 + "contents", True), ("x\n" * 10 + "contents", False), ("the contents", False), ("", False), (" contents", True)]
    df = spark.createDataFrame([(t,) for t, _ in pages], "t string")
    assert [(r.t, r.c) for r in df.select("t", X.is_contents(F.split("t", "\n")).alias("c")).collect()] == pages


def test_halves_go_away_from_zero(spark):
    df = spark.createDataFrame([(x,) for x in (12.5, 10.5, 0.25, 9.95, -12.5, 1234.5, 3.0)], "x double")
    assert [r[0] for r in df.select(X.value_label(F.col("x"))).collect()] == ["13", "11", "0.3", "10", "-13", "1,235", "3"]


def test_a_prefix_is_the_whole_text(spark):
    df = spark.createDataFrame([("GR&C - RM",), ("gr&c/occo",), ("GR&C-RM-X",), ("GR&CRM",)], "t string")
    assert [r[0] for r in df.select(X.canonical_prefix(F.col("t"))).collect()] == ["GR&C-RM", "GR&C-OCCO", "GR&C-RM-X", "GR&C-RM"]
