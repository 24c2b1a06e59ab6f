"""Field comparison over the driver's tables: two extractions of orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import accuracy as A
from quillspark.plans.catalog import query
from quillspark.plans.records import table

FIELDS = ["status", "lines", "first_ship", "returned"]

COMPARED_SQL = r"""
WITH li AS (
  SELECT l_orderkey AS doc, count(*) AS lines, count(DISTINCT l_linenumber) AS numbers, min(l_shipdate) AS first, min(l_shipdate) FILTER (l_returnflag <> 'A') AS first2, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1
), w AS (
  SELECT o_orderkey AS doc, o_orderstatus AS s1, CASE WHEN o_orderpriority = '5-LOW' THEN ' ' || o_orderstatus || ' ' WHEN o_orderpriority = '1-URGENT' THEN 'None' ELSE o_orderstatus END AS s2,
    CAST(lines AS VARCHAR) AS l1, CAST(numbers AS VARCHAR) || '.0' AS l2, strftime(first, '%d/%m/%Y') AS d1, strftime(first2, '%d.%m.%Y') AS d2,
    CASE WHEN returned = 0 THEN 'check' ELSE CAST(returned AS VARCHAR) END AS r1, CAST(returned AS VARCHAR) AS r2
  FROM orders LEFT JOIN li ON doc = o_orderkey
), p AS (
  SELECT doc, 'status' AS field, s1 AS script_value, s2 AS actual_value FROM w UNION ALL SELECT doc, 'lines', l1, l2 FROM w UNION ALL SELECT doc, 'first_ship', d1, d2 FROM w UNION ALL SELECT doc, 'returned', r1, r2 FROM w
), n AS (
  SELECT *, trim(regexp_replace(coalesce(script_value, ''), '\s+', ' ', 'g')) AS a, trim(regexp_replace(coalesce(actual_value, ''), '\s+', ' ', 'g')) AS b FROM p
), m AS (
  SELECT doc, field, script_value, actual_value, CASE WHEN lower(a) = 'none' THEN '' ELSE a END AS a, CASE WHEN lower(b) = 'none' THEN '' ELSE b END AS b FROM n
), v AS (
  SELECT doc, field, script_value, actual_value,
    CASE WHEN field = 'first_ship' THEN CASE WHEN regexp_extract(a, '(\d{2})[./](\d{2})[./](\d{4})', 1) = '' THEN '' ELSE regexp_replace(a, '^.*?(\d{2})[./](\d{2})[./](\d{4}).*$', '\1/\2/\3') END ELSE a END AS script_norm,
    CASE WHEN field = 'first_ship' THEN CASE WHEN regexp_extract(b, '(\d{2})[./](\d{2})[./](\d{4})', 1) = '' THEN '' ELSE regexp_replace(b, '^.*?(\d{2})[./](\d{2})[./](\d{4}).*$', '\1/\2/\3') END ELSE b END AS actual_norm,
    CASE WHEN regexp_full_match(a, '-?\d+(\.\d+)?') AND regexp_full_match(b, '-?\d+(\.\d+)?') THEN CAST(a AS DOUBLE) - CAST(b AS DOUBLE) END AS delta,
    CASE WHEN regexp_full_match(a, '-?\d+(\.\d+)?') AND regexp_full_match(b, '-?\d+(\.\d+)?') THEN CAST(b AS DOUBLE) END AS base
  FROM m
), c AS (
  SELECT doc, field, script_value, actual_value, script_norm, actual_norm, delta, delta / nullif(base, 0) AS pct_delta, CASE WHEN delta IS NOT NULL THEN delta = 0 ELSE script_norm = actual_norm END AS match FROM v
), x AS (
  SELECT *, CASE WHEN script_norm = '' AND actual_norm = '' THEN 'both blank' WHEN match THEN 'match' ELSE 'mismatch' END AS status FROM c
)
"""


def compared(spark, d):
    line = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(
        F.count("*").alias("lines"), F.countDistinct("l_linenumber").alias("numbers"), F.min("l_shipdate").alias("first"), F.min(F.when(F.col("l_returnflag") != "A", F.col("l_shipdate"))).alias("first2"), F.count_if(F.col("l_returnflag") == "R").alias("n"),
    )
    both = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc"), "o_orderstatus", "o_orderpriority").join(line, "doc", "left")
    shown = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))).when(F.col("o_orderpriority") == "1-URGENT", "None").otherwise(F.col("o_orderstatus"))
    script = both.select("doc", F.col("o_orderstatus").alias("status"), "lines", F.date_format("first", "dd/MM/yyyy").alias("first_ship"), F.when(F.col("n") == 0, "check").otherwise(F.col("n").cast("string")).alias("returned"))
    actual = both.select("doc", shown.alias("status"), F.concat(F.col("numbers").cast("string"), F.lit(".0")).alias("lines"), F.date_format("first2", "dd.MM.yyyy").alias("first_ship"), F.col("n").alias("returned"))
    return A.compare(A.field_pairs(script, actual, "doc", FIELDS), ["first_ship"])


@query(COMPARED_SQL + "SELECT * FROM x")
def field_comparison(spark, d):
    return compared(spark, d)


@query(COMPARED_SQL + """
SELECT field, count(*) AS compared, count(*) FILTER (match) AS matches, count(*) FILTER (NOT match) AS mismatches, round(100.0 * count(*) FILTER (match) / count(*), 4) AS match_rate,
  round(avg(abs(delta)), 6) AS mean_abs_delta, round(max(abs(delta)), 6) AS max_abs_delta FROM x GROUP BY field""")  # fmt: skip
def field_accuracy_stats(spark, d):
    return A.field_stats(compared(spark, d))


@query(COMPARED_SQL + "SELECT doc, count(*) AS compared, count(*) FILTER (match) AS matches, coalesce(string_agg(field, ', ' ORDER BY field) FILTER (NOT match), '') AS mismatched FROM x GROUP BY doc")
def document_accuracy(spark, d):
    return A.document_stats(compared(spark, d), "doc")


@query(COMPARED_SQL + """
, g AS (SELECT doc, count(*) AS n, count(*) FILTER (match) AS m FROM x GROUP BY doc)
SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS compared, CAST(sum(m) AS BIGINT) AS matches, round(100.0 * sum(m) / sum(n), 4) AS match_rate, count(*) FILTER (n = m) AS perfect FROM g""")  # fmt: skip
def accuracy_overall(spark, d):
    return A.overall(compared(spark, d), "doc")
