"""Integration over the driver's tables in the roles of notes, projects and files."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.dates import date_status, swapped
from quillspark.functions.names import clean_key
from quillspark.operators import joins as J
from quillspark.plans.catalog import query
from quillspark.plans.records import records, table, with_records


@query("""
WITH s AS (SELECT nullif(s_nationkey, 0) AS key, s_suppkey, s_name, s_acctbal, row_number() OVER (PARTITION BY nullif(s_nationkey, 0) ORDER BY s_suppkey) AS k FROM supplier)
SELECT c_custkey, nullif(c_nationkey, 0) AS note_key, s_suppkey, s_name, s_acctbal FROM customer LEFT JOIN s ON nullif(c_nationkey, 0) IS NOT DISTINCT FROM key AND k = 1""")  # fmt: skip
def nullsafe_left_join_first_row(spark, d):
    """Customers are notes, suppliers the projects; nation 0 stands for a missing key on both sides."""
    notes = table(spark, d, "customer").select("c_custkey", F.nullif("c_nationkey", F.lit(0)).alias("note_key"))
    projects = table(spark, d, "supplier").select(F.nullif("s_nationkey", F.lit(0)).alias("key"), "s_suppkey", "s_name", "s_acctbal")
    return J.null_safe_left_join(notes, projects, "note_key", "key", "s_suppkey")


@query(with_records("""
SELECT note_id, template, CASE WHEN template = 'OTHER' THEN validation_date WHEN template = 'AFS' THEN bo_date WHEN template IN ('GNG', 'PIN') THEN bo_month END AS "BO Validation Date",
  CASE WHEN template <> 'OTHER' THEN author END AS "BO Author", CASE WHEN template IN ('AFS', 'GNG') THEN product END AS financing_product, CASE WHEN template IN ('AFS', 'GNG') THEN extraction END AS special_activities,
  CASE WHEN template IN ('AFS', 'GNG') THEN team_pj END AS "BO PJ", CASE WHEN template IN ('AFS', 'GNG') THEN team_rm END AS "BO RM", CASE WHEN template IN ('AFS', 'GNG') THEN team_ju END AS "BO JU",
  CASE WHEN template IN ('AFS', 'GNG') THEN team_econ END AS "BO ECON", CASE WHEN template = 'AFS' THEN process ELSE 'N/A' END AS "New AFS Process" FROM records"""))  # fmt: skip
def master_conditional_columns(spark, d):
    r = records(spark, d).select(
        "note_id", "template", "validation_date", F.col("bo_date").alias("bo_afs_date"), F.col("bo_month").alias("bo_pin_gng_date"), F.col("author").alias("bo_author"), F.col("product").alias("bo_product"),
        F.col("extraction").alias("bo_flag"), F.col("team_pj").alias("bo_pj"), F.col("team_rm").alias("bo_rm"), F.col("team_ju").alias("bo_ju"), F.col("team_econ").alias("bo_sg"), F.col("process").alias("bo_process"),
    )
    return J.master_columns(r).drop("validation_date")


FILES_SQL = """
WITH p AS (SELECT p_partkey, p_size, p_brand, p_name || ' ' || CAST(p_partkey AS VARCHAR) AS base FROM part),
notes AS (SELECT p_partkey AS id, p_brand AS template, base || '.pdf' AS name, regexp_replace(upper(base), '[^A-Z0-9]', '', 'g') AS clean FROM p),
files AS (
  SELECT p_partkey AS file, CASE WHEN p_size BETWEEN 21 AND 30 THEN 'MOVED' ELSE p_brand END AS template,
    CASE WHEN p_size <= 10 THEN base || '.pdf' WHEN p_size <= 30 THEN '12. ' || upper(base) || '.PDF' WHEN p_size <= 40 THEN 'note on ' || base || ' final.pdf' ELSE 'other ' || CAST(p_size AS VARCHAR) || '.pdf' END AS name, p_partkey AS ordinal FROM p
), f AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(upper(name), '\\.PDF$', ''), '^\\s*\\d+\\s*[.)_-]+\\s*', ''), '[^A-Z0-9]', '', 'g') AS clean FROM files),
"""


@query(FILES_SQL + """
e AS (SELECT name, arg_max(file, ordinal) AS file1 FROM f GROUP BY name), t AS (SELECT template, clean, max(file) AS file2, count(*) AS n2 FROM f GROUP BY ALL), g AS (SELECT clean, max(file) AS file3, count(*) AS n3 FROM f GROUP BY clean),
m AS (
  SELECT n.id, n.template, n.clean, file1, CASE WHEN n2 = 1 THEN file2 END AS file2, CASE WHEN n3 = 1 THEN file3 END AS file3 FROM notes AS n LEFT JOIN e USING (name) LEFT JOIN t ON t.template = n.template AND t.clean = n.clean LEFT JOIN g ON g.clean = n.clean
), c AS (
  SELECT m.id, max(f.file) AS file4 FROM m JOIN f ON f.template = m.template AND (contains(f.clean, m.clean) OR contains(m.clean, f.clean)) WHERE coalesce(file1, file2, file3) IS NULL AND m.clean <> '' AND f.clean <> '' GROUP BY m.id HAVING count(*) = 1
)
SELECT m.id, coalesce(file1, file2, file3, file4) AS file,
  CASE WHEN file1 IS NOT NULL THEN 'exact_file_name' WHEN file2 IS NOT NULL THEN 'template_clean_name' WHEN file3 IS NOT NULL THEN 'global_clean_name' WHEN file4 IS NOT NULL THEN 'template_clean_contains' ELSE 'unmatched' END AS match_method
FROM m LEFT JOIN c USING (id)""")  # fmt: skip
def match_cascade(spark, d):
    """Parts are notes; their files carry the same, a prefixed, a moved or a longer name, by size."""
    base = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_brand", base.alias("base"))
    notes = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("template"), F.concat("base", F.lit(".pdf")).alias("name"), clean_key(F.col("base"), True).alias("clean"))
    name = (
        F.when(F.col("p_size") <= 10, F.concat("base", F.lit(".pdf"))).when(F.col("p_size") <= 30, F.concat(F.lit("12. "), F.upper("base"), F.lit(".PDF")))
        .when(F.col("p_size") <= 40, F.concat(F.lit("note on "), "base", F.lit(" final.pdf"))).otherwise(F.concat(F.lit("other "), F.col("p_size").cast("string"), F.lit(".pdf")))
    )
    files = p.select(F.col("p_partkey").alias("file"), F.when(F.col("p_size").between(21, 30), "MOVED").otherwise(F.col("p_brand")).alias("template"), name.alias("name"), F.col("p_partkey").alias("ordinal"))
    return J.match_cascade(notes, files.withColumn("clean", clean_key(F.col("name"), True)))


SHIPPED_SQL = """
WITH f AS (SELECT CASE WHEN p_size <= 25 THEN p_name ELSE upper(p_name) END AS name, CAST(date_trunc('year', l_shipdate) AS DATE) AS day, l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey),
"""


@query(SHIPPED_SQL + """
g AS (SELECT name, count(*) AS files, count(DISTINCT day) AS distinct_values, min(day) AS one FROM f GROUP BY name)
SELECT name, files, distinct_values, CASE WHEN distinct_values > 1 THEN 'ambiguous' WHEN distinct_values = 1 THEN 'ok' ELSE 'no date' END AS status, CASE WHEN distinct_values = 1 THEN one END AS day FROM g""")
def name_conflicts(spark, d):
    return J.unambiguous(_shipped(spark, d), "name", "day")


def _shipped(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") <= 25, F.col("p_name")).otherwise(F.upper("p_name")).alias("name"))
    line = table(spark, d, "lineitem").select("l_partkey", F.trunc(F.col("l_shipdate").cast("date"), "year").alias("day"))
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select("name", "day")


@query("""
WITH f AS (SELECT CASE WHEN s_acctbal < 5000 THEN s_name ELSE upper(s_name) END AS name, CAST(DATE '2020-01-01' + CAST(s_nationkey AS INTEGER) AS DATE) AS day FROM supplier),
l AS (SELECT 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS name, c_custkey FROM customer),
e AS (SELECT name, min(day) AS d1 FROM f GROUP BY name HAVING count(DISTINCT day) = 1), n AS (SELECT lower(trim(name)) AS fold, min(day) AS d2 FROM f GROUP BY 1 HAVING count(DISTINCT day) = 1)
SELECT l.name, c_custkey, coalesce(d1, d2) AS day, CASE WHEN d1 IS NOT NULL THEN 'exact' WHEN d2 IS NOT NULL THEN 'normalised' ELSE 'none' END AS method FROM l LEFT JOIN e USING (name) LEFT JOIN n ON n.fold = lower(trim(l.name))""")  # fmt: skip
def two_tier_name_join(spark, d):
    files = table(spark, d, "supplier").select(F.when(F.col("s_acctbal") < 5000, F.col("s_name")).otherwise(F.upper("s_name")).alias("name"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("s_nationkey").cast("int")).alias("day"))
    left = table(spark, d, "customer").select(F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("name"), "c_custkey")
    return J.two_tier_join(left, files, "name", "day", lambda c: F.lower(F.trim(c)))


@query("""
WITH k AS (SELECT p_partkey, p_retailprice, p_size, unnest(CASE WHEN p_name = upper(p_name) THEN [p_name] ELSE [p_name, upper(p_name)] END) AS key FROM part), m AS (SELECT key, arg_max(p_retailprice, p_partkey) AS value FROM k GROUP BY key)
SELECT p_partkey, coalesce(a.value, b.value) AS price FROM (SELECT p_partkey, p_type AS k1, upper(p_name) AS k2 FROM part) AS p LEFT JOIN m AS a ON a.key = p.k1 LEFT JOIN m AS b ON b.key = p.k2""")  # fmt: skip
def fallback_key_lookup(spark, d):
    part = table(spark, d, "part")
    lookup = J.visible_lookup(part.select("p_name", F.upper("p_name").alias("upper"), "p_retailprice", "p_partkey"), "p_name", "upper", "p_retailprice", ["p_partkey"])
    rows = part.select("p_partkey", F.col("p_type").alias("k1"), F.upper("p_name").alias("k2"))
    return J.fallback_lookup(rows, lookup, ["k1", "k2"], "price").select("p_partkey", "price")


SWAP_SQL = "CASE WHEN day({d}) <= 12 THEN make_date(year({d}), day({d}), month({d})) END"


@query(with_records(f"SELECT note_id, validation_date, {SWAP_SQL.format(d='validation_date')} AS swapped FROM records"))
def day_month_swap(spark, d):
    return records(spark, d).select("note_id", "validation_date", swapped(F.col("validation_date")).alias("swapped"))


@query(with_records(f"""
, s AS (SELECT note_id, CASE WHEN pages = 1 THEN NULL ELSE validation_date END AS db, CASE WHEN pages = 2 THEN NULL WHEN pages <= 4 THEN validation_date WHEN pages = 5 THEN {SWAP_SQL.format(d='validation_date')} ELSE bo_date END AS vis,
  CASE WHEN pages = 6 THEN validation_date WHEN pages = 7 THEN bo_date END AS fil FROM records)
SELECT note_id, CASE WHEN db IS NULL THEN 'missing_db_date' WHEN vis IS NULL THEN 'no_visible_date' WHEN db = vis THEN 'db_matches_visible' WHEN db = {SWAP_SQL.format(d='vis')} THEN 'db_is_visible_day_month_swap'
  WHEN fil IS NOT NULL AND db = fil AND vis <> fil THEN 'db_matches_filename_not_visible' WHEN fil IS NOT NULL AND vis = fil THEN 'visible_matches_filename_db_differs' ELSE 'db_visible_mismatch' END AS status FROM s"""))  # fmt: skip
def date_status_classify(spark, d):
    """The three dates of a note, by how many lines its order has."""
    p, v = F.col("pages"), F.col("validation_date")
    db = F.when(p == 1, F.lit(None)).otherwise(v)
    visible = F.when(p == 2, F.lit(None)).when(p <= 4, v).when(p == 5, swapped(v)).otherwise(F.col("bo_date"))
    file = F.when(p == 6, v).when(p == 7, F.col("bo_date"))
    return records(spark, d).select("note_id", db.cast("date").alias("db"), visible.alias("vis"), file.alias("fil")).select("note_id", date_status(F.col("db"), F.col("vis"), F.col("fil")).alias("status"))


@query("""
SELECT o_orderkey, coalesce(fixed, CAST(o_orderdate AS DATE)) AS validation_date FROM orders LEFT JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS fixed FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")
def date_override_join(spark, d):
    fixes = table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.col("l_shipdate").cast("date")).alias("fixed"))
    return J.override(table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("validation_date")), fixes, "o_orderkey", "validation_date", "fixed")


PREFIXES = ["P", "PROMO", "STAND", "STANDARD", "SMALL", "LARGE", "ECON", "ECONOMY", "RING", "BOLT"]


@query("WITH h AS (SELECT p_partkey, p_type || ' ' || upper(p_name) AS header FROM part) SELECT p_partkey, header, CASE " + " ".join(f"WHEN strpos(header, '{p}') BETWEEN 1 AND 18 THEN '{p}'" for p in sorted(PREFIXES, key=lambda p: (-len(p), p))) + " END AS prefix FROM h")
def longest_prefix_match(spark, d):
    h = table(spark, d, "part").select("p_partkey", F.concat("p_type", F.lit(" "), F.upper("p_name")).alias("header"))
    return h.withColumn("prefix", J.longest_prefix(h, F.col("header"), PREFIXES))


@query("""
WITH c AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority, o_orderstatus FROM orders), f AS (SELECT year(day) AS year, o_orderpriority, count(*) AS n FROM c WHERE o_orderstatus = 'F' AND month(day) = 1 GROUP BY ALL)
SELECT y.year, p.o_orderpriority, coalesce(n, 0) AS n FROM (SELECT DISTINCT year FROM f) AS y CROSS JOIN (SELECT DISTINCT o_orderpriority FROM f) AS p LEFT JOIN f ON f.year = y.year AND f.o_orderpriority = p.o_orderpriority""")  # fmt: skip
def grid_completion(spark, d):
    o = table(spark, d, "orders").filter((F.col("o_orderstatus") == "F") & (F.month("o_orderdate") == 1))
    return J.complete_grid(o.groupBy(F.year("o_orderdate").cast("long").alias("year"), "o_orderpriority").agg(F.count("*").alias("n")), "year", "o_orderpriority", "n")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def unmatched_listed(spark, d):
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


MARKERS = ["the", "and", "of", "is", "for", "with"]


@query("""
WITH l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)),
s AS (SELECT doc_id, i, len(list_distinct(list_filter(string_split(line, ' '), lambda w: list_contains(['the', 'and', 'of', 'is', 'for', 'with'], w)))) AS score FROM l),
k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS k FROM s)
SELECT doc_id, CAST(i - 1 AS BIGINT) AS header_line, CAST(score AS BIGINT) AS score FROM k WHERE k = 1""")  # fmt: skip
def header_marker_score(spark, d):
    """The line of each document that names most markers, the first of equal ones."""
    marks = F.array(*[F.lit(m) for m in MARKERS])
    scores = F.transform(F.split("text", "\n"), lambda x, i: F.struct((-F.size(F.array_intersect(F.split(x, " "), marks))).alias("s"), i.alias("i")))
    best = F.array_min(scores)
    return table(spark, d, "documents").filter("text is not null").select("doc_id", best["i"].cast("long").alias("header_line"), (-best["s"]).cast("long").alias("score"))
