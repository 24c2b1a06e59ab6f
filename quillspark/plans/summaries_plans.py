"""Summaries over the driver's tables, each with its equivalent in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators import summaries as S
from quillspark.operators.trends import monthly
from quillspark.plans.catalog import query
from quillspark.plans.records import SERVICES, records, with_records
from quillspark.sources.readers import excel_sheet
from quillspark.sources.workbook import sheet_names, write_workbook
from quillspark.stages import shared_dir

TEAMS = {"PJ": "team_pj", "RM": "team_rm", "JU": "team_ju", "ECON": "team_econ"}

STATS_SQL = """count(*) AS documents, count(*) FILTER (extraction = 'Manual') AS manual, count(*) FILTER (extraction = 'Automated') AS automated,
  round(100.0 * count(*) FILTER (extraction = 'Manual') / count(*), 2) AS manual_rate,
  round(sum(words), 2) AS words_sum, round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median,
  round(quantile_cont(words, 0.25), 4) AS words_p25, round(quantile_cont(words, 0.75), 4) AS words_p75, round(quantile_cont(words, 0.9), 4) AS words_p90,
  round(stddev_samp(words), 6) AS words_std, min(words) AS words_min, max(words) AS words_max,
  round(avg(pages), 6) AS pages_mean, round(quantile_cont(pages, 0.5), 4) AS pages_median,
  round(avg(pages_before), 6) AS pages_before_mean, round(avg(annex_pages), 6) AS annex_mean,
  round(avg(words_per_page), 6) AS per_page_mean, round(avg(words_per_pre_page), 6) AS per_pre_page_mean,
  round(avg(service_words), 6) AS service_words_mean, min(validation_date) AS first_date, max(validation_date) AS last_date"""


def _overview(name: str, *keys: str) -> None:
    query(with_records(f"SELECT {', '.join(keys)}, {STATS_SQL} FROM records GROUP BY {', '.join(keys)}"), name)(lambda spark, d: S.overview(records(spark, d), *keys))


_overview("template_overview", "template")
_overview("template_extraction_overview", "template", "extraction")
_overview("batch_overview", "batch", "template")


SETS = {"template": ["template"], "extraction": ["template", "extraction"], "batch": ["batch", "template"], "month": ["month", "template"], "year": ["year", "template"]}
SET_KEYS = ["template", "extraction", "batch", "month", "year"]
#: By which of SET_KEYS each grouping goes, as the bits that GROUPING tells.
SET_BITS = {name: sum((k not in own) << (len(SET_KEYS) - 1 - n) for n, k in enumerate(SET_KEYS)) for name, own in SETS.items()}
SETS_SQL = f"""
, keyed AS (SELECT *, extraction AS by_extraction FROM records)
SELECT CASE grouping(template, by_extraction, batch, month, year) {' '.join(f"WHEN {bits} THEN '{name}'" for name, bits in SET_BITS.items())} END AS grouping,
  template, by_extraction AS extraction, batch, month, year, {STATS_SQL.replace("extraction = ", "keyed.extraction = ")}
FROM keyed GROUP BY GROUPING SETS ({', '.join('(' + ', '.join('by_extraction' if k == 'extraction' else k for k in own) + ')' for own in SETS.values())})"""


@query(with_records(SETS_SQL))
def overview_grouping_sets(spark, d):
    """The five overviews in one pass over the records; records without a month or year are a group of their own."""
    return S.overview_sets(records(spark, d), SETS)


@query(with_records(f"SELECT month, template, {STATS_SQL} FROM records WHERE month IS NOT NULL GROUP BY month, template"))
def monthly_time_series(spark, d):
    return S.time_series(records(spark, d), "month")


@query(with_records(f"SELECT year, template, {STATS_SQL} FROM records WHERE year IS NOT NULL GROUP BY year, template"))
def yearly_time_series(spark, d):
    return S.time_series(records(spark, d), "year")


@query(with_records("""
, g AS (
  SELECT template, service, count(words) AS filled, count(*) FILTER (words > 0) AS positive, round(sum(coalesce(words, 0)), 2) AS words_sum,
    round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median, round(quantile_cont(words, 0.9), 4) AS words_p90
  FROM opinions GROUP BY template, service
)
SELECT *, round(coalesce(100 * words_sum / nullif(sum(words_sum) OVER (PARTITION BY template), 0), 0), 4) AS share FROM g""", True))  # fmt: skip
def department_totals_share(spark, d):
    return S.department_totals(records(spark, d), SERVICES)


@query(with_records("""
SELECT template, extraction, count(*) AS documents, round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median,
  round(avg(pages), 6) AS pages_mean, round(quantile_cont(service_words, 0.5), 4) AS service_words_median
FROM records GROUP BY template, extraction"""))  # fmt: skip
def manual_effect(spark, d):
    return S.extraction_effect(records(spark, d))


@query(with_records("""
SELECT product, count(*) AS documents, string_agg(DISTINCT template, ', ' ORDER BY template) AS templates, count(bo_date) AS with_bo_date,
  round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median, min(validation_date) AS first_date, max(validation_date) AS last_date
FROM records GROUP BY product"""))  # fmt: skip
def product_overview(spark, d):
    return S.product_overview(records(spark, d))


TEAM_SQL = """
, t AS (
  SELECT note_id, product, 'PJ' AS service, team_pj AS team, PJ AS words FROM records
  UNION ALL SELECT note_id, product, 'RM', team_rm, RM FROM records
  UNION ALL SELECT note_id, product, 'JU', team_ju, JU FROM records
  UNION ALL SELECT note_id, product, 'ECON', team_econ, ECON FROM records
), o AS (SELECT * FROM t WHERE words > 0 AND team IS NOT NULL AND upper(trim(team)) NOT IN ('#', 'N/A', 'NA', 'NONE', ''))
"""


@query(with_records(TEAM_SQL + """
, m AS (
  SELECT service, team, product, row_number() OVER (PARTITION BY service, team ORDER BY count(*) DESC, product) AS k FROM o WHERE product IS NOT NULL GROUP BY service, team, product
), g AS (
  SELECT service, team, count(*) AS opinions, count(DISTINCT note_id) AS documents, round(sum(words), 2) AS words_sum, round(sum(words), 6) / nullif(count(words), 0) AS words_mean,
    round(quantile_cont(words, 0.5), 4) AS words_median, min(words) AS words_min, max(words) AS words_max
  FROM o GROUP BY service, team
)
SELECT g.*, m.product AS top_product FROM g LEFT JOIN m ON g.service = m.service AND g.team = m.team AND m.k = 1"""))  # fmt: skip
def team_opinion_summary(spark, d):
    return S.team_opinions(records(spark, d), TEAMS)


@query(with_records(TEAM_SQL + """
, g AS (SELECT service, team, count(*) AS opinions, round(quantile_cont(words, 0.5), 4) AS words_median FROM o GROUP BY service, team HAVING count(*) >= 3),
r AS (
  SELECT *, row_number() OVER (PARTITION BY service ORDER BY words_median DESC, opinions DESC, team) AS high,
    row_number() OVER (PARTITION BY service ORDER BY words_median, opinions DESC, team) AS low FROM g
)
SELECT service, 'highest' AS extreme, team, opinions, words_median FROM r WHERE high = 1
UNION ALL SELECT service, 'lowest', team, opinions, words_median FROM r WHERE low = 1"""))  # fmt: skip
def team_extremes(spark, d):
    return S.team_extremes(records(spark, d), TEAMS)


@query(with_records("""
, s AS (
  SELECT CAST(count(*) AS DOUBLE) AS "rows", CAST(count(bo_date) AS DOUBLE) AS with_date, CAST(count(*) - count(bo_date) AS DOUBLE) AS without_date,
    CAST(count(*) FILTER (delta_days = 0) AS DOUBLE) AS same_day, CAST(count(*) FILTER (delta_days < 0) AS DOUBLE) AS before, CAST(count(*) FILTER (delta_days > 0) AS DOUBLE) AS after,
    round(quantile_cont(CAST(delta_days AS DOUBLE), 0.5), 4) AS median_days, round(avg(delta_days), 6) AS mean_days FROM records
)
UNPIVOT s ON "rows", with_date, without_date, same_day, before, after, median_days, mean_days INTO NAME metric VALUE value"""))  # fmt: skip
def bo_delta_summary(spark, d):
    return S.bo_delta_summary(records(spark, d))


@query(with_records("""
SELECT CASE WHEN delta_days IS NULL THEN 'No date' WHEN delta_days = 0 THEN 'Same day' WHEN delta_days < -30 THEN 'Over 30 days before' WHEN delta_days < 0 THEN '1-30 days before'
  WHEN delta_days <= 30 THEN '1-30 days after' WHEN delta_days <= 90 THEN '31-90 days after' ELSE 'Over 90 days after' END AS bucket, count(*) AS documents
FROM records GROUP BY 1"""))  # fmt: skip
def bo_delta_histogram(spark, d):
    return S.bo_delta_histogram(records(spark, d))


CORRELATED = ["words", "pages", "pages_before", "annex_pages", "service_words", "service_sections", "words_per_page"]


@query(with_records("\nUNION ALL ".join(f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 4) AS corr FROM records" for a in CORRELATED for b in CORRELATED)))
def correlation_matrix(spark, d):
    return S.correlations(records(spark, d), CORRELATED)


FLAG_SQL = "SELECT '{flag}' AS flag, note_id, batch, template, extraction, file_name, validation_date, bo_date, pages, words, product FROM gaps WHERE {rule}"
#: A third of the driver's records without annexes, and the last month as the future, so that each flag occurs.
GAPS_SQL = """, gaps AS (SELECT * REPLACE (CASE WHEN note_id % 3 > 0 THEN annex_pages END AS annex_pages, CASE WHEN note_id % 7 > 0 THEN validation_date END AS validation_date, coalesce(note_id % 7 > 0 AND validation_date > DATE '2001-07-01', false) AS is_future) FROM records)
"""


def _gaps(spark, d):
    later = (F.col("note_id") % 7 > 0) & (F.col("validation_date") > F.lit("2001-07-01").cast("date"))
    return records(spark, d).withColumns({
        "annex_pages": F.when(F.col("note_id") % 3 > 0, F.col("annex_pages")), "is_future": F.coalesce(later, F.lit(False)),
        "validation_date": F.when(F.col("note_id") % 7 > 0, F.col("validation_date")),
    })


@query(with_records(GAPS_SQL + " UNION ALL ".join(FLAG_SQL.format(flag=f, rule=r) for f, r in (
    ("Missing validation date", "validation_date IS NULL"), ("Future validation date", "is_future"), ("Missing annex page count", "annex_pages IS NULL"), ("Missing BO validation date", "bo_date IS NULL"),
))))
def quality_flags_union(spark, d):
    return S.quality_flags(_gaps(spark, d))


@query(with_records(GAPS_SQL + """
SELECT 'Missing date' AS flag, count(*) FILTER (validation_date IS NULL) AS n FROM gaps UNION ALL SELECT 'Future date', count(*) FILTER (is_future) FROM gaps
UNION ALL SELECT 'Missing BO date', count(*) FILTER (bo_date IS NULL) FROM gaps"""))  # fmt: skip
def quality_flag_counts(spark, d):
    return S.quality_flag_counts(_gaps(spark, d))


@query(with_records("""
SELECT count(*) AS documents, count(DISTINCT template) AS templates, count(DISTINCT batch) AS batches, count(DISTINCT author) AS authors,
  round(sum(coalesce(words, 0)), 2) AS words_sum, round(avg(coalesce(words, 0)), 6) AS words_mean, round(quantile_cont(coalesce(words, 0), 0.5), 4) AS words_median,
  round(avg(coalesce(pages, 0)), 6) AS pages_mean, round(quantile_cont(coalesce(pages, 0), 0.5), 4) AS pages_median, round(avg(coalesce(annex_pages, 0)), 6) AS annex_mean,
  round(100 * avg(CASE WHEN extraction = 'Manual' THEN 1.0 ELSE 0.0 END), 2) AS manual_rate, round(100 * avg(CASE WHEN service_sections > 0 THEN 1.0 ELSE 0.0 END), 2) AS opinion_rate,
  min(validation_date) AS first_date, max(validation_date) AS last_date FROM records"""))  # fmt: skip
def kpi_summary_null0(spark, d):
    return S.kpis(records(spark, d), SERVICES)


AUTHOR_SQL = """count(*) AS documents, round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median,
  round(100 * avg(CASE WHEN extraction = 'Manual' THEN 1.0 ELSE 0.0 END), 2) AS manual_rate, round(avg(pages), 6) AS pages_mean, max(validation_date) AS last_date"""


@query(with_records(f"SELECT author, {AUTHOR_SQL} FROM records WHERE author IS NOT NULL GROUP BY author HAVING count(*) >= 10"))
def author_stats_min_docs(spark, d):
    return S.authors(records(spark, d), 10)


@query(with_records(f"SELECT author, template, {AUTHOR_SQL} FROM records WHERE author IS NOT NULL GROUP BY author, template HAVING count(*) >= 3"))
def author_template_stats(spark, d):
    return S.authors(records(spark, d), 3, "template")


@query(with_records("""
, b AS (SELECT template, round(quantile_cont(words, 0.5), 4) AS template_median FROM records WHERE author IS NOT NULL GROUP BY template),
a AS (SELECT template, author, count(*) AS documents, round(quantile_cont(words, 0.5), 4) AS author_median FROM records WHERE author IS NOT NULL GROUP BY template, author HAVING count(*) >= 5)
SELECT a.*, template_median, round(author_median - template_median, 4) AS effect FROM a JOIN b USING (template)"""))  # fmt: skip
def author_effect_vs_median(spark, d):
    return S.author_effect(records(spark, d), 5)


@query(with_records("""
, a AS (SELECT template, author, count(*) AS documents, round(sum(words), 6) / nullif(count(words), 0) AS words_mean FROM records WHERE author IS NOT NULL GROUP BY template, author HAVING count(*) >= 3)
SELECT *, dense_rank() OVER (PARTITION BY template ORDER BY words_mean DESC) AS rank FROM a"""))  # fmt: skip
def author_dense_rank(spark, d):
    return S.author_ranks(records(spark, d), 3)


@query(with_records("SELECT template, count(*) AS documents, count(*) - count(author) AS missing, round(100 * avg(CASE WHEN author IS NULL THEN 1.0 ELSE 0.0 END), 2) AS missing_rate FROM records GROUP BY template"))
def author_coverage(spark, d):
    return S.author_coverage(records(spark, d))


@query(with_records("SELECT template, " + ", ".join(f"round(quantile_cont(coalesce(words, 0), 0.{q:02d}), 4) AS p{q}" for q in (5, 25, 50, 75, 95)) + " FROM records GROUP BY template"))
def box_percentiles(spark, d):
    return S.box_percentiles(records(spark, d))


@query(with_records("SELECT year, " + ", ".join(f"count(*) FILTER (month(validation_date) = {m}) AS m{m}" for m in range(1, 13)) + " FROM records WHERE validation_date IS NOT NULL GROUP BY year"))
def calendar_heatmap_pivot(spark, d):
    return S.calendar(records(spark, d))


@query(with_records("""
, g AS (SELECT service, template, round(sum(coalesce(words, 0)), 2) AS words FROM opinions GROUP BY service, template),
t AS (SELECT service FROM g GROUP BY service ORDER BY sum(words) DESC, service LIMIT 5)
SELECT g.* FROM g JOIN t USING (service)""", True))  # fmt: skip
def dept_heat_matrix(spark, d):
    return S.department_matrix(records(spark, d), SERVICES, 5)


@query(with_records("""
SELECT batch, count(*) AS documents, string_agg(DISTINCT template, ', ' ORDER BY template) AS templates, round(100 * avg(CASE WHEN extraction = 'Manual' THEN 1.0 ELSE 0.0 END), 2) AS manual_rate,
  round(quantile_cont(coalesce(words, 0), 0.5), 4) AS words_median, min(validation_date) AS first_date, max(validation_date) AS last_date FROM records GROUP BY batch"""))  # fmt: skip
def batch_summary(spark, d):
    return S.batches(records(spark, d))


@query(with_records("SELECT month, template, count(*) AS documents, round(quantile_cont(words, 0.5), 4) AS words_median, round(quantile_cont(pages, 0.5), 4) AS pages_median FROM records WHERE month IS NOT NULL GROUP BY month, template"))
def workbook_round_trip(spark, d):
    """The months of all templates, written as a sheet of a workbook beside other tables, and read from it with types."""
    months = monthly(records(spark, d)).orderBy("month", "template")
    kept = T.StructType([T.StructField("month", T.DateType()), T.StructField("template", T.StringType()), T.StructField("documents", T.LongType()), T.StructField("words_median", T.DoubleType()), T.StructField("pages_median", T.DoubleType())])
    path = f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}.xlsx"
    write_workbook({"templates": S.value_counts(records(spark, d), "template"), "months of every template, in the order of time": months}, path)
    return excel_sheet(spark, path, sheet_names(["months of every template, in the order of time"])[0], 0, kept)
