"""The driver's order tables in the roles of note records, and the same records as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.derive import derive

#: Services by line number of an order's lines.
SERVICES = ["OPS", "PJ", "RM", "JU", "ECON", "SG", "OTHER"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order. Lines are summed by order before any join, so the join moves one row for each order."""
    line = table(spark, sf_dir, "lineitem")
    per_order = line.groupBy("l_orderkey").agg(
        F.count("*").cast("double").alias("pages"),
        F.count_if(F.col("l_returnflag") == "R").cast("double").alias("annex_pages"),
        F.count_if(F.col("l_linestatus") == "F").cast("double").alias("pages_before"),
        F.min("l_shipdate").cast("date").alias("bo_date"),
        *[F.sum(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(s) for k, s in enumerate(SERVICES, 1)],
    )
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "c_name", "c_mktsegment", "n_name", "r_name")
    )
    first = F.substring("o_orderpriority", 1, 1)
    template = F.when(first == "1", "afs ").when(first == "2", "GNG").when(first == "3", "Other").when(first == "4", "PIN").otherwise("OTHER")
    orders = table(spark, sf_dir, "orders").join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("note_id"),
        template.alias("template"),
        F.when(F.col("o_orderstatus") == "F", "Manual").when(F.col("o_orderstatus") == "O", "Automated").alias("extraction"),
        F.concat(F.lit("B"), F.year("o_orderdate").cast("string")).alias("batch"),
        F.concat(F.lit("note-"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("file_name"),
        F.col("c_mktsegment").alias("product"),
        F.col("c_name").alias("author"),
        F.when(F.year("bo_date") >= 1998, "New").when(F.col("bo_date").isNotNull(), "Old").alias("process"),
        F.when(F.col("o_custkey") % 10 > 0, F.concat(F.lit("Matched "), F.substring("o_orderpriority", 1, 1))).alias("ged_status"),
        F.col("n_name").alias("team_pj"), F.col("r_name").alias("team_rm"), F.col("c_mktsegment").alias("team_ju"), F.col("n_name").alias("team_econ"),
        F.col("o_orderdate").cast("date").alias("validation_date"),
        "bo_date",
        F.col("o_totalprice").alias("words"),
        "pages", "pages_before", "annex_pages", *SERVICES,
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(raw_records(spark, sf_dir), SERVICES)


RECORDS_SQL = (
    """
per_order AS (
  SELECT l_orderkey, CAST(count(*) AS DOUBLE) AS pages, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS annex_pages,
    CAST(count(*) FILTER (l_linestatus = 'F') AS DOUBLE) AS pages_before, CAST(min(l_shipdate) AS DATE) AS bo_date,
"""
    + ",\n".join(f"    sum(l_quantity) FILTER (l_linenumber = {k}) AS {s}" for k, s in enumerate(SERVICES, 1))
    + """
  FROM lineitem GROUP BY l_orderkey
), records AS (
  SELECT o_orderkey AS note_id,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'AFS' WHEN '2' THEN 'GNG' WHEN '4' THEN 'PIN' ELSE 'OTHER' END AS template,
    CASE o_orderstatus WHEN 'F' THEN 'Manual' WHEN 'O' THEN 'Automated' END AS extraction,
    'B' || CAST(year(o_orderdate) AS VARCHAR) AS batch, 'note-' || CAST(o_orderkey AS VARCHAR) || '.pdf' AS file_name,
    coalesce(c_mktsegment, 'Missing product') AS product, c_name AS author,
    CASE WHEN year(bo_date) >= 1998 THEN 'New' WHEN bo_date IS NOT NULL THEN 'Old' END AS process,
    CASE WHEN o_custkey % 10 > 0 THEN 'Matched ' || substr(o_orderpriority, 1, 1) END AS ged_status,
    n_name AS team_pj, r_name AS team_rm, c_mktsegment AS team_ju, n_name AS team_econ,
    CAST(o_orderdate AS DATE) AS validation_date, bo_date, o_totalprice AS words, pages, pages_before, annex_pages,
"""
    + "    " + ", ".join(SERVICES) + ",\n    "
    + " + ".join(f"coalesce({s}, 0)" for s in SERVICES) + " AS service_words,\n    "
    + " + ".join(f"CAST(coalesce({s}, 0) > 0 AS BIGINT)" for s in SERVICES) + " AS service_sections,\n"
    + """    o_totalprice / nullif(pages, 0) AS words_per_page, o_totalprice / nullif(pages_before, 0) AS words_per_pre_page,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS month, year(o_orderdate) AS year,
    CAST(year(o_orderdate) AS VARCHAR) || ' Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
    CAST(date_trunc('month', bo_date) AS DATE) AS bo_month, year(bo_date) AS bo_year,
    CAST(date_diff('day', CAST(o_orderdate AS DATE), bo_date) AS BIGINT) AS delta_days,
    o_orderdate IS NOT NULL AS has_date, bo_date IS NOT NULL AS has_bo_date, CAST(o_orderdate AS DATE) > DATE '2026-06-02' AS is_future
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""
)

OPINIONS_SQL = (
    "opinions AS (\n"
    + "\nUNION ALL ".join(f"SELECT note_id, template, product, author, month, year, quarter, process, validation_date, is_future, '{s}' AS service, {s} AS words FROM records" for s in SERVICES)
    + "\n)"
)


def with_records(body: str, opinions: bool = False) -> str:
    """A query over the names records and, if asked for, opinions."""
    body = body.lstrip()
    return f"WITH {RECORDS_SQL}{', ' + OPINIONS_SQL if opinions else ''}\n{body}"
