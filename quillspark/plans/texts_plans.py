"""Text scalars and line operators over the driver's documents, conversations and pages."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillspark.functions import text as X
from quillspark.functions.dates import filename_date, meta_date, parse_date, path_year, visible_date
from quillspark.functions.names import clean_key, fold_key, repair_mojibake
from quillspark.functions.sql import register
from quillspark.operators import lines as L
from quillspark.plans.catalog import query
from quillspark.plans.records import table


def docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text", "lang", "source")


def flat_sql(text: str) -> str:
    """A text as its words are counted, in SQL."""
    plain = f"regexp_replace(translate({text}, '\u2019\u2018\u00a0\u2010\u2011\u2012\u2013\u2014\u2212', chr(39) || chr(39) || ' ------'), '[\u00ad\u200b-\u200d\ufeff]', '', 'g')"
    joined = rf"regexp_replace({plain}, '([\p{{L}}\p{{N}}_])-\s*\n\s*([\p{{L}}\p{{N}}_])', '\1\2', 'g')"
    unmarked = rf"replace(regexp_replace({joined}, '(?m)^\s*[oO]\s+', '', 'g'), 'ï‚·', '')"
    return rf"trim(regexp_replace(translate({unmarked}, '&-/', ''), '\s+', ' ', 'g'))"


WORD_SQL = r"[\p{L}\p{N}]+(?:''[\p{L}\p{N}]+)?"
#: Texts as notes write them: words cut at line ends, joined by slashes and hyphens, bullets at the starts of lines.
NOTED_SQL = "replace(replace(replace(replace(text, 'en ', 'en-' || chr(10) || ' '), 'a ', 'a/'), 's ', 's' || chr(10) || ' o '), 'o ', 'o\u2013')"


def noted(c):
    for what, by in (("en ", "en-\n "), ("a ", "a/"), ("s ", "s\n o "), ("o ", "o\u2013")):
        c = F.replace(c, F.lit(what), F.lit(by))
    return c


@query(f"SELECT doc_id, CAST(len(regexp_extract_all({flat_sql('text')}, '{WORD_SQL}')) AS BIGINT) AS words, CAST(len(regexp_extract_all({flat_sql(NOTED_SQL)}, '{WORD_SQL}')) AS BIGINT) AS noted_words FROM documents")
def word_count_unicode(spark, d):
    """Words of each text, and of the text with the marks that notes have."""
    return docs(spark, d).select("doc_id", X.word_count(F.col("text")).alias("words"), X.word_count(noted(F.col("text"))).alias("noted_words"))


@query()
def word_count_ascii(spark, d):
    return docs(spark, d).select("doc_id", X.ascii_word_count(F.col("text")).alias("words"))


@query(f"SELECT lang, count(*) AS documents, CAST(sum(len(regexp_extract_all({flat_sql('text')}, '{WORD_SQL}'))) AS BIGINT) AS words, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY lang")
def corpus_volume(spark, d):
    return docs(spark, d).groupBy("lang").agg(F.count("*").alias("documents"), F.sum(X.word_count(F.col("text"))).alias("words"), F.sum(F.length("text").cast("long")).alias("chars"))


LINES_SQL = """
WITH l AS (SELECT doc_id, i - 1 AS ord, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents))
"""

NOISE_SQL = LINES_SQL + r""", z AS (
  SELECT *, CASE WHEN trim(line) = '' THEN 'blank line' WHEN regexp_matches(trim(line), '^\s*-\s*\d+\s*-\s*$') THEN 'page number'
    WHEN regexp_matches(line, '(?i)\b\d+\s+of\s+\d+\b') THEN 'x of y page marker' WHEN regexp_matches(line, '(?i)\bMC[_\s-]?GNG\b') THEN 'MC_GNG footer'
    WHEN lower(trim(line)) = 'corporate use' THEN 'Corporate Use footer' END AS reason,
    list_filter(regexp_split_to_array(trim(line), '\s+'), lambda x: x <> '') AS tokens
  FROM (SELECT doc_id, ord, CASE ord % 5 WHEN 1 THEN ' - ' || ord || ' - ' WHEN 2 THEN 'page ' || ord || ' Of 90 ' || line WHEN 3 THEN 'MC GNG ' || line WHEN 4 THEN 'Corporate use ' ELSE line END AS line FROM l WHERE ord < 5 UNION ALL SELECT doc_id, ord, line FROM l)
)
"""


def _footed(spark, d):
    """The driver's lines, and before them the first five of each text with the footers of notes."""
    lines, k = L.explode_lines(docs(spark, d)).select("doc_id", "ord", "line"), F.col("ord") % 5
    n = F.col("ord").cast("string")
    foot = F.when(k == 1, F.concat(F.lit(" - "), n, F.lit(" - "))).when(k == 2, F.concat(F.lit("page "), n, F.lit(" Of 90 "), "line")).when(k == 3, F.concat(F.lit("MC GNG "), "line")).when(k == 4, "Corporate use ").otherwise(F.col("line"))
    return lines.filter("ord < 5").withColumn("line", foot).unionByName(lines)


@query(NOISE_SQL + "SELECT doc_id, reason, count(*) AS lines FROM z GROUP BY doc_id, reason")
def noise_line_filter(spark, d):
    return _footed(spark, d).withColumn("reason", X.noise_reason(F.col("line"), "GNG")).groupBy("doc_id", "reason").agg(F.count("*").alias("lines"))


@query(NOISE_SQL + r"""SELECT doc_id, count(*) AS lines, count(*) FILTER (len(tokens) >= 4 AND 2 * len(list_filter(tokens, lambda x: regexp_full_match(translate(x, ',.%', ''), '\d+'))) > len(tokens)) AS table_lines FROM z GROUP BY doc_id""")
def table_line_counts(spark, d):
    return _footed(spark, d).groupBy("doc_id").agg(F.count("*").alias("lines"), F.count_if(X.is_table_line(F.col("line"))).alias("table_lines"))


@query("""
WITH s AS (SELECT conv_id, turn, text, CAST(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM conversations)
SELECT conv_id, segment, count(*) AS lines, min(turn) AS first_turn, max(turn) AS last_turn, CAST(sum(length(text)) AS BIGINT) AS chars FROM s GROUP BY conv_id, segment""")  # fmt: skip
def heading_segments(spark, d):
    """Turns of a user are the headings of a conversation."""
    lines = L.segments(table(spark, d, "conversations"), F.col("role") == "user", "conv_id", "turn")
    return lines.groupBy("conv_id", "segment").agg(F.count("*").alias("lines"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.sum(F.length("text").cast("long")).alias("chars"))


@query("SELECT conv_id, min(turn) FILTER (role = 'assistant') AS stop FROM conversations GROUP BY conv_id")
def first_stop_marker(spark, d):
    return L.first_marker(table(spark, d, "conversations"), F.col("role") == "assistant", "conv_id", "turn", "stop")


@query("""
WITH m AS (SELECT conv_id, min(turn) FILTER (role = 'assistant') AS stop FROM conversations GROUP BY conv_id)
SELECT c.conv_id, turn, role FROM conversations AS c JOIN m USING (conv_id) WHERE stop IS NULL OR turn < stop""")  # fmt: skip
def lines_before_marker(spark, d):
    return L.until_marker(table(spark, d, "conversations"), F.col("role") == "assistant", "conv_id", "turn").select("conv_id", "turn", "role")


@query("SELECT conv_id, turn, role FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations) WHERE b IS NULL OR b IS DISTINCT FROM role")
def consecutive_duplicates(spark, d):
    return L.drop_repeats(table(spark, d, "conversations").select("conv_id", "turn", "role"), "role", "conv_id", "turn")


PAGES_SQL = """
WITH p AS (SELECT conv_id, turn, CAST(coalesce(sum(length(text) + 1) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, length(text) AS n FROM conversations),
t AS (SELECT conv_id, CAST(sum(length(text) + 1) AS BIGINT) // 2 AS position FROM conversations GROUP BY conv_id)
"""


@query(PAGES_SQL + "SELECT t.conv_id, position, turn FROM t JOIN p ON p.conv_id = t.conv_id AND position >= start AND position <= start + n")
def position_to_page(spark, d):
    """Turns are the pages of a conversation; the point sought is its middle."""
    pages = L.positions(table(spark, d, "conversations"), "conv_id", "turn", "text")
    middle = table(spark, d, "conversations").groupBy("conv_id").agg(F.floor(F.sum(F.length("text") + 1) / 2).cast("long").alias("position"))
    return L.page_of(pages, middle, "conv_id", "turn").select("conv_id", "position", "turn")


@query("SELECT conv_id, turn, min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS next_answer FROM conversations")
def look_ahead_window(spark, d):
    c = table(spark, d, "conversations")
    return c.select("conv_id", "turn", L.ahead(F.when(F.col("role") == "assistant", F.col("turn")), 5, "conv_id", "turn").alias("next_answer"))


@query(r"""
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(split_part(text, chr(10), 1))), '\.PDF$', ''), '^\s*\d+\s*[.)_-]+\s*', ''), '[^A-Z0-9]', '', 'g') AS key FROM documents""")  # fmt: skip
def clean_name_key(spark, d):
    return docs(spark, d).select("doc_id", clean_key(F.substring_index("text", "\n", 1)).alias("key"))


@query()
def mojibake_repair(spark, d):
    """Every text as Windows-1252 would show its bytes, and repaired again."""
    broken = F.pandas_udf(_broken, "string")(F.col("text"))
    return docs(spark, d).withColumn("broken", broken).select("doc_id", F.sha2(repair_mojibake(F.col("broken")), 256).alias("repaired"), F.sha2("text", 256).alias("original"))


def _broken(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.encode().decode("cp1252", "replace"))


@query("SELECT doc_id, lower(trim(nfc_normalize(split_part(text, chr(10), 1)))) AS key FROM documents")
def fold_name_key(spark, d):
    return docs(spark, d).select("doc_id", fold_key(F.substring_index("text", "\n", 1)).alias("key"))


@query(r"""
WITH n AS (SELECT o_orderkey, 'NoteMCDec_' || strftime(o_orderdate, '%Y-%m-%d') || '_' || CAST(o_custkey AS VARCHAR) || '.pdf' AS name FROM orders)
SELECT o_orderkey, CAST(regexp_extract(name, '(20\d{2}[-_]\d{2}[-_]\d{2})', 1) AS VARCHAR) AS raw, try_cast(nullif(regexp_extract(name, '(20\d{2}[-_]\d{2}[-_]\d{2})', 1), '') AS DATE) AS day, 'NOTEMCDEC' AS kind FROM n""")
def file_name_facts(spark, d):
    name = F.concat(F.lit("NoteMCDec_"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("_"), F.col("o_custkey").cast("string"), F.lit(".pdf"))
    n = table(spark, d, "orders").select("o_orderkey", name.alias("name"))
    return n.select("o_orderkey", F.regexp_extract("name", r"(20\d{2}[-_]\d{2}[-_]\d{2})", 1).alias("raw"), filename_date(F.col("name")).alias("day"), X.note_type(F.col("name")).alias("kind"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '31.02.2020' END AS raw,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")  # fmt: skip
def date_parse_formats(spark, d):
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy")).when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("31.02.2020")
    return table(spark, d, "orders").select("o_orderkey", raw.alias("raw")).withColumn("day", parse_date(F.col("raw")))


@query(r"""
WITH p AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'gr & c - rm' WHEN 2 THEN 'GR&C/OCCO' WHEN 3 THEN 'occo' WHEN 4 THEN 'ops' ELSE l_returnflag || '/' || l_linestatus END AS raw, l_quantity FROM lineitem),
c AS (SELECT *, CASE raw WHEN 'gr & c - rm' THEN 'RM' WHEN 'GR&C/OCCO' THEN 'OCCO' WHEN 'occo' THEN 'OCCO' WHEN 'ops' THEN 'OPS' ELSE replace(raw, '/', '-') END AS service FROM p)
SELECT service, count(*) AS segments, round(sum(l_quantity), 2) AS words FROM c GROUP BY service""")  # fmt: skip
def prefix_merge_totals(spark, d):
    n = F.col("l_linenumber")
    raw = F.when(n == 1, "gr & c - rm").when(n == 2, "GR&C/OCCO").when(n == 3, "occo").when(n == 4, "ops").otherwise(F.concat("l_returnflag", F.lit("/"), "l_linestatus"))
    return table(spark, d, "lineitem").select(X.export_prefix(X.canonical_prefix(raw)).alias("service"), "l_quantity").groupBy("service").agg(F.count("*").alias("segments"), F.round(F.sum("l_quantity"), 2).alias("words"))


@query(f"SELECT doc_id, md5({flat_sql(NOTED_SQL)}) AS flat_md5, length({flat_sql(NOTED_SQL)}) AS flat_chars FROM documents")
def flattened_text(spark, d):
    """Whole texts with words cut at line ends, slashes, dashes and bullets, on one line."""
    flat = docs(spark, d).select("doc_id", X.flatten(noted(F.col("text"))).alias("flat"))
    return flat.select("doc_id", F.md5("flat").alias("flat_md5"), F.length("flat").cast("long").alias("flat_chars"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN printf('%08d', 20000000 + o_orderkey % 99999) ELSE strftime(o_orderdate, '%Y') || printf('%04d', o_orderkey % 10000) END AS number FROM orders""")
def operation_numbers(spark, d):
    """Every other order has its number in the name, the others, with a hyphen, in the text."""
    k = F.col("o_orderkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("AFS "), F.format_string("%08d", 20000000 + k % 99999), F.lit(" note.pdf"))).otherwise("note.pdf")
    text = F.concat(F.lit("see operation "), F.date_format("o_orderdate", "yyyy"), F.lit("-"), F.format_string("%04d", k % 10000), F.lit("."))
    return table(spark, d, "orders").select("o_orderkey", X.operation_number(name, text, "AFS").alias("number"))


@query("""
SELECT o_orderkey, CAST(strftime(o_orderdate, '20%y-%m-%d') AS DATE) AS visible, CAST(o_orderdate AS DATE) + 1 AS created, CAST(year(o_orderdate) AS INTEGER) AS path_year FROM orders
WHERE strftime(o_orderdate, '%m-%d') <> '02-29'""")
def dates_of_a_note(spark, d):
    """The date of a letterhead that another date precedes, the date of metadata, and the year of a path."""
    day = F.col("o_orderdate")
    o = table(spark, d, "orders").filter(F.date_format(day, "MM-dd") != "02-29").select(
        "o_orderkey", F.concat(F.lit("ref 01.02.2003 Luxembourg, "), F.date_format(day, "dd.MM.'20'yy")).alias("text"), F.concat(F.lit("D:"), F.date_format(F.date_add(day, 1), "yyyyMMdd"), F.lit("120000Z")).alias("meta"),
        F.concat(F.lit("notes/"), F.date_format(day, "yyyy"), F.lit("/n.pdf")).alias("path"),
    )
    return o.select("o_orderkey", visible_date(F.col("text")).alias("visible"), meta_date(F.col("meta")).alias("created"), path_year(F.col("path")).alias("path_year"))


@query("""
WITH p AS (
  SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN chr(10) || ' Contents ..... ' || turn || chr(10) || text WHEN 1 THEN text || chr(10) || '1. Table of contents' WHEN 2 THEN repeat(chr(10), 12) || 'CONTENTS' || chr(10) || text ELSE text END AS page
  FROM conversations
), l AS (SELECT conv_id, turn, list_filter(list_transform(string_split(page, chr(10)), lambda x: lower(trim(x))), lambda x: x <> '')[1:10] AS lines FROM p)
SELECT conv_id, turn, len(list_filter(lines, lambda x: starts_with(x, 'contents') OR contains(x, 'table of contents'))) > 0 AS contents FROM l""")  # fmt: skip
def contents_pages(spark, d):
    """Every turn is a page, before or after whose text another line may announce its contents."""
    k, text = F.col("conv_id") % 4, F.col("text")
    dotted = F.concat(F.lit("\n Contents ..... "), F.col("turn").cast("string"), F.lit("\n"), text)
    page = F.when(k == 0, dotted).when(k == 1, F.concat(text, F.lit("\n1. Table of contents"))).when(k == 2, F.concat(F.lit("\n" * 12 + "CONTENTS\n"), text)).otherwise(text)
    return table(spark, d, "conversations").select("conv_id", "turn", X.is_contents(F.split(page, "\n")).alias("contents"))


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Buildings' WHEN 'MACHINERY' THEN 'Machines' ELSE c_mktsegment END AS segment, CASE WHEN length(c_name) > 12 THEN substr(c_name, 1, 11) || '...' ELSE c_name END AS short, '&lt;' || c_mktsegment || '&amp;&quot;' AS marked FROM customer")
def display_labels(spark, d):
    marked = X.html_text(F.concat(F.lit("<"), "c_mktsegment", F.lit('&"')))
    return table(spark, d, "customer").select("c_custkey", X.label(F.col("c_mktsegment"), {"BUILDING": "Buildings", "MACHINERY": "Machines"}).alias("segment"), X.short_label(F.col("c_name"), 12).alias("short"), marked.alias("marked"))


@query("""
WITH v AS (SELECT o_orderkey, o_totalprice, (o_orderkey % 100) / 4.0 AS x FROM orders)
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS price, CAST(CAST(floor(x + 0.5) AS BIGINT) AS VARCHAR) || '%' AS share,
  CASE WHEN x < 10 AND x % 1 > 0.01 THEN regexp_replace(format('{:.1f}', floor(x * 10 + 0.5) / 10), '\\.0$', '') ELSE CAST(CAST(floor(x + 0.5) AS BIGINT) AS VARCHAR) END || ' d' AS days FROM v""")  # fmt: skip
def display_numbers(spark, d):
    """Quarters, so that every other number is a half at the digit where it is cut."""
    x = (F.col("o_orderkey") % 100) / 4.0
    return table(spark, d, "orders").select("o_orderkey", X.thousands(F.col("o_totalprice"), 2).alias("price"), X.value_label(x, "%").alias("share"), X.value_label(x, " d").alias("days"))


@query(f"""
SELECT doc_id, CAST(len(regexp_extract_all({flat_sql('text')}, '{WORD_SQL}')) AS BIGINT) AS words, md5({flat_sql('text')}) AS flat_md5,
  regexp_replace(regexp_replace(regexp_replace(upper(strip_accents(text)), '\\.PDF$', ''), '^\\s*\\d+\\s*[.)_-]+\\s*', ''), '[^A-Z0-9]', '', 'g') AS key,
  CASE WHEN length(source) > 28 THEN substr(source, 1, 27) || '...' ELSE source END AS short FROM documents""")  # fmt: skip
def functions_in_sql(spark, d):
    """Column functions by their names in SQL, over whole texts."""
    register(spark)
    return spark.sql("SELECT doc_id, word_count(text) AS words, md5(flatten_note(text)) AS flat_md5, clean_name(text) AS key, short_label(source) AS short FROM {docs}", docs=docs(spark, d))
