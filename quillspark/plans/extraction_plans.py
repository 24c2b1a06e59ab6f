"""Extraction over notes made of the driver's conversations: each turn is a page."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.sql import register_tables
from quillspark.operators import extraction as X
from quillspark.plans.catalog import query
from quillspark.plans.records import table


def _pages(spark, d, first: str, heads: list[str], last: str):
    c = table(spark, d, "conversations")
    n = F.max("turn").over(W.partitionBy("conv_id"))
    k = F.col("turn")
    head = F.coalesce(*[F.when(k == i, F.lit(h)) for i, h in enumerate(heads, 2)], F.lit(""))
    text = F.when(k == 0, F.col("text")).when(k == 1, F.concat("text", F.lit("\n" + first + "\n"))).when(k == n, F.concat("text", F.lit("\n" + last + "\n"))).otherwise(F.concat(head, F.lit("\n"), "text"))
    return c.select(F.col("conv_id").alias("doc_id"), (k + 1).alias("page_no"), text.alias("page_text"))


@query()
def gng_note_rows(spark, d):
    return X.extract_gng(_pages(spark, d, "6. Services' acknowledgement", ["PJ contribution", "GR&C - RM", "ECON", "JU"], "Expected timetable\nGNG validation"))


@query()
def afs_note_rows(spark, d):
    return X.extract_afs(_pages(spark, d, "4. Services Opinions", ["PJ Opinion", "GR&C-RM position", "A. SG ECON input", "JU"], "5. Timetable\nFact Sheet validation"))


@query()
def other_opinion_scan(spark, d):
    return X.extract_other(_pages(spark, d, "6 OPINIONS FROM THE SERVICES", ["6.1 PJ Opinion", "Validated by SMITH John\n6.2 GR&C-RM Opinion", "Validated by DOE Jane\n6.3 JU Opinion", "Validated by ROE Ann\n"], "Validated by LAST Person"))


@query()
def other_notes_in_sql(spark, d):
    """The OTHER notes by the table function: pages are dealt by note and come in order."""
    register_tables(spark)
    pages = _pages(spark, d, "6 OPINIONS FROM THE SERVICES", ["6.1 PJ Opinion", "Validated by SMITH John\n6.2 GR&C-RM Opinion", "Validated by DOE Jane\n6.3 JU Opinion", "Validated by ROE Ann\n"], "Validated by LAST Person")
    return spark.sql("SELECT * FROM other_note(TABLE({pages}) PARTITION BY doc_id ORDER BY page_no)", pages=pages)


@query("SELECT page_id AS doc_id, '0' || substr(CAST(page_id AS VARCHAR), 1, 1) || '/05/2024' AS date, CASE WHEN page_id < 100 THEN 1 ELSE 3 END AS stage FROM pages")
def header_date_stages(spark, d):
    """Each page of the driver's web pages is a block at the right top of a letter."""
    p = table(spark, d, "pages")
    blocks = p.select(
        F.col("page_id").alias("doc_id"), F.lit(1).alias("page_no"), F.lit(600.0).alias("page_w"), F.lit(800.0).alias("page_h"), F.when(F.col("page_id") < 100, 300.0).otherwise(10.0).alias("x0"),
        F.lit(20.0).alias("y0"), F.lit(500.0).alias("x1"), F.lit(60.0).alias("y1"), F.concat(F.lit("Corporate Use\nLuxembourg, 0"), F.substring(F.col("page_id").cast("string"), 1, 1), F.lit(".05.2024\n"), "html").alias("text"), F.lit(1).alias("ord"),
    )
    return X.header_dates(blocks)


@query("""
SELECT conv_id AS doc_id, strftime(DATE '2020-01-01' + CAST(conv_id % 1000 AS INTEGER), '%d/%m/%Y') AS date, 'OPS/' || CASE conv_id % 3 WHEN 0 THEN 'ABCD' WHEN 1 THEN 'LONG' ELSE 'PART' END AS author
FROM conversations GROUP BY conv_id""")  # fmt: skip
def corner_dates_and_authors(spark, d):
    """A corner of five lines for each conversation: a code before the date doesn't count."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id")).distinct()
    day = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 1000).cast("int")), "dd/MM/yyyy")
    code = F.concat(F.lit("OPS/"), F.when(F.col("doc_id") % 3 == 0, "ABCD").when(F.col("doc_id") % 3 == 1, "LONG").otherwise("PART"))
    lines = F.array(F.lit("SG/EARLY"), F.lit("plain words"), F.concat(F.lit("Date: "), day), F.lit("Corporate use"), code)
    return X.corner_date_author(c.select("doc_id", F.posexplode(lines).alias("ord", "text")))


#: Pages made of the turns of conversations of three turns or more, with what opens and closes the sections of a note.
NOTE_SQL = """
WITH c AS (SELECT conv_id, turn, text, max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations),
p AS (SELECT conv_id, turn, CASE WHEN turn = 1 THEN text || chr(10) || {opening} || chr(10) || text WHEN turn = last THEN text || chr(10) || {closing} ELSE text END AS page FROM c WHERE last >= 2),
l AS (SELECT conv_id, turn, i, trim(string_split(page, chr(10))[i]) AS line FROM (SELECT conv_id, turn, page, unnest(range(1, len(string_split(page, chr(10))) + 1)) AS i FROM p)),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, i) AS ord FROM l)
"""


def _marked_pages(spark, d, opening: str, closing: str):
    c = table(spark, d, "conversations").withColumn("last", F.max("turn").over(W.partitionBy("conv_id"))).filter("last >= 2")
    page = F.when(F.col("turn") == 1, F.concat("text", F.lit(f"\n{opening}\n"), "text")).when(F.col("turn") == F.col("last"), F.concat("text", F.lit(f"\n{closing}"))).otherwise(F.col("text"))
    return c.select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_no"), page.alias("page_text"))


def _removed_and_headings(found):
    reasons = F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["ord"], r["reason"])), ";")
    return found.withColumns({"removed": F.md5(reasons), "n_removed": F.size("removed").cast("long"), "headings": F.array_join(F.transform(F.filter("headings", lambda h: h["accepted"]), lambda h: h["prefix"]), ";")})


GNG_OPENING, GNG_CLOSING = "6. Services\u2019 acknowledgement\nPJ contribution\nPJ\nGR&C - RM", "- 3 -\n\nMC_GNG 7\nExpected timetable"
AFS_OPENING, AFS_CLOSING = "4. Services Opinions\nPJ Opinion\nA. SG ECON input", "- 3 -\nMC AFS 2\nfor Corporate use\n5. Timetable"
_lines_sql = lambda text: " || chr(10) || ".join("'" + x.replace("'", "''") + "'" for x in text.split("\n"))


@query(NOTE_SQL.format(opening=_lines_sql(GNG_OPENING), closing=_lines_sql(GNG_CLOSING)) + r"""
, s AS (SELECT conv_id, min(ord) FILTER (starts_with(line, '6. Services')) AS a, min(ord) FILTER (line = 'Expected timetable') AS b, min(turn) FILTER (starts_with(line, '6. Services')) AS page FROM n GROUP BY conv_id),
r AS (
  SELECT n.conv_id, ord, line, CASE WHEN line = '' THEN 'blank line' WHEN regexp_matches(line, '^\s*-\s*\d+\s*-\s*$') THEN 'page number' WHEN regexp_matches(line, '(?i)\b\d+\s+of\s+\d+\b') THEN 'x of y page marker'
    WHEN regexp_matches(line, '(?i)\bMC[_\s-]?GNG\b') THEN 'MC_GNG footer' WHEN lower(line) = 'corporate use' THEN 'Corporate Use footer' END AS reason
  FROM n JOIN s ON s.conv_id = n.conv_id AND ord BETWEEN a AND b)
SELECT s.conv_id AS doc_id, true AS section_found, '6. Services'' acknowledgement' AS section_text, CAST(s.page + 1 AS INTEGER) AS section_page, 'Expected timetable' AS stop_text, CAST(s.b AS INTEGER) AS stop_line,
  md5(coalesce(string_agg(ord || ':' || reason, ';' ORDER BY ord) FILTER (reason IS NOT NULL), '')) AS removed, count(reason) AS n_removed, 'PJ;GR&C-RM' AS headings
FROM s JOIN r ON r.conv_id = s.conv_id GROUP BY s.conv_id, s.page, s.b""")
def gng_note_provenance(spark, d):
    """What opened and closed the section of each note, which lines of its whole text were left out, and its headings."""
    found = X.gng_provenance(_marked_pages(spark, d, GNG_OPENING, GNG_CLOSING))
    return _removed_and_headings(found).select("doc_id", "section_found", "section_text", "section_page", "stop_text", "stop_line", "removed", "n_removed", "headings")


@query(NOTE_SQL.format(opening=_lines_sql(AFS_OPENING), closing=_lines_sql(AFS_CLOSING)) + r"""
, s AS (SELECT conv_id, min(ord) FILTER (line = 'PJ Opinion') AS a, min(ord) FILTER (line = '5. Timetable') AS b, min(turn) FILTER (line = 'PJ Opinion') AS page FROM n GROUP BY conv_id),
r AS (
  SELECT n.conv_id, ord, line, CASE WHEN line = '' THEN 'blank line' WHEN regexp_matches(line, '^\s*-\s*\d+\s*-\s*$') THEN 'page number' WHEN regexp_matches(line, '(?i)\b\d+\s+of\s+\d+\b') THEN 'x of y page marker'
    WHEN regexp_matches(line, '(?i)\bMC\s+AFS\b') THEN 'MC AFS footer' WHEN regexp_matches(line, '(?i)\bConfidential\b') THEN 'Confidential footer/header' WHEN regexp_matches(line, '(?i)corporate use') THEN 'Corporate Use footer' END AS reason
  FROM n JOIN s ON s.conv_id = n.conv_id AND ord >= a AND ord < b)
SELECT s.conv_id AS doc_id, 'primary_to_first_counted' AS mode, 'PJ Opinion' AS start_text, CAST(s.page + 1 AS INTEGER) AS start_page, CAST(s.a AS INTEGER) AS start_line, '5. Timetable' AS stop_text, CAST(s.b AS INTEGER) AS stop_line,
  md5(coalesce(string_agg(ord || ':' || reason, ';' ORDER BY ord) FILTER (reason IS NOT NULL), '')) AS removed, count(reason) AS n_removed, 'PJ;SG ECON' AS headings
FROM s JOIN r ON r.conv_id = s.conv_id GROUP BY s.conv_id, s.page, s.a, s.b""")
def afs_note_provenance(spark, d):
    """How the opinions of each note were found and closed, which lines of them were left out, and what opens them."""
    found = X.afs_provenance(_marked_pages(spark, d, AFS_OPENING, AFS_CLOSING))
    return _removed_and_headings(found).select("doc_id", "mode", "start_text", "start_page", "start_line", "stop_text", "stop_line", "removed", "n_removed", "headings")


@query()
def other_note_provenance(spark, d):
    """Every header that the scan of an OTHER note looks at, and what became of it."""
    found = X.other_provenance(_marked_pages(spark, d, "6 OPINIONS FROM THE SERVICES\n6.1 PJ Opinion", "Validated by SMITH John\n6.2 QQ Opinion\n6.3 JU Opinion\nValidated by DOE Jane\n6.4 ECON Opinion"))
    return found.select("doc_id", "title", F.explode("headers").alias("h")).select("doc_id", "title", "h.*")
