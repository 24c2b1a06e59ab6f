"""Data tests over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import checks as Q
from quillspark.plans.catalog import query
from quillspark.plans.records import SERVICES, records, with_records

EXPECTED = ["OPS", "PJ", "RM", "JU", "ECON"]


@query(with_records("SELECT note_id, template, service, words FROM opinions WHERE template = 'GNG' AND service NOT IN ('OPS', 'PJ', 'RM', 'JU', 'ECON') AND words > 0", True))
def dq_unexpected_department(spark, d):
    return Q.unexpected_services(records(spark, d), SERVICES, "GNG", EXPECTED)


@query(with_records("""
, g AS (SELECT service, count(*) AS documents, round(100 * avg(CASE WHEN words > 0 THEN 1.0 ELSE 0.0 END), 4) AS coverage FROM opinions WHERE template = 'GNG' AND service IN ('OPS', 'PJ', 'RM', 'JU', 'ECON') GROUP BY service)
SELECT *, CASE WHEN coverage >= 50 THEN 'pass' ELSE 'warn' END AS status FROM g""", True))  # fmt: skip
def dq_coverage(spark, d):
    return Q.coverage(records(spark, d), "GNG", EXPECTED, 50.0)


@query(with_records("SELECT o.note_id, o.template, r.words_per_page AS total, o.service, o.words * 3000 AS words FROM opinions AS o JOIN records AS r USING (note_id) WHERE o.words * 3000 > r.words_per_page", True))
def dq_exceeds_total(spark, d):
    """A line's quantity stands for 3000 words of a page, so that some findings occur."""
    scaled = records(spark, d).withColumns({s: F.col(s) * 3000 for s in SERVICES} | {"words": F.col("words_per_page")})
    return Q.exceeds_total(scaled, SERVICES)


@query(with_records("SELECT note_id, template, words / 3000 AS words, service_words, round(service_words / (words / 3000), 6) AS ratio FROM records WHERE service_words / nullif(words / 3000, 0) > 1.25"))
def dq_ratio(spark, d):
    return Q.high_ratio(records(spark, d).withColumn("words", F.col("words") / 3000))


@query(with_records("SELECT note_id, template, validation_date, bo_date FROM records WHERE validation_date > DATE '2001-07-01'"))
def dq_future_dates(spark, d):
    """The last month of the driver's orders stands for the future."""
    return Q.flagged(records(spark, d), F.col("validation_date") > F.lit("2001-07-01").cast("date"))


@query(with_records("SELECT note_id, template, validation_date, bo_date FROM records WHERE NOT has_bo_date OR NOT has_date"))
def dq_missing_dates(spark, d):
    return Q.flagged(records(spark, d), ~F.col("has_bo_date") | ~F.col("has_date"))


@query(with_records("""
, q AS (SELECT template, round(quantile_cont(words, 0.4), 6) AS q1, round(quantile_cont(words, 0.6), 6) AS q3 FROM records GROUP BY template),
b AS (SELECT template, greatest(0, q1 - 0.5 * (q3 - q1)) AS low, q3 + 0.5 * (q3 - q1) AS high FROM (SELECT template, round(quantile_cont(words, 0.25), 6) AS q1, round(quantile_cont(words, 0.75), 6) AS q3 FROM records GROUP BY template))
SELECT note_id, template, words, round(low, 6) AS low, round(high, 6) AS high FROM records JOIN b USING (template) WHERE words < low OR words > high"""))  # fmt: skip
def dq_iqr_outliers(spark, d):
    """Half the usual distance, as the driver's prices are even and have no outliers at one and a half."""
    return Q.iqr_outliers(records(spark, d), 0.5)


@query(with_records("""
, g AS (SELECT template, round(quantile_cont(words, 0.5) FILTER (extraction = 'Manual'), 4) AS manual_median, round(quantile_cont(words, 0.5) FILTER (extraction = 'Automated'), 4) AS automated_median FROM records GROUP BY template)
SELECT *, round(manual_median - automated_median, 6) AS difference FROM g WHERE manual_median IS NOT NULL AND automated_median IS NOT NULL"""))  # fmt: skip
def dq_manual_auto_median(spark, d):
    return Q.manual_against_automated(records(spark, d))


@query(with_records("""
, f AS (SELECT DISTINCT template FROM records WHERE SG > 0)
SELECT string_agg(template, ', ' ORDER BY template) AS found, coalesce(string_agg(template, ', ' ORDER BY template) FILTER (template <> 'OTHER'), '') AS unexpected,
  CASE WHEN count(*) FILTER (template <> 'OTHER') = 0 THEN 'pass' ELSE 'warn' END AS status FROM f"""))  # fmt: skip
def dq_subset_check(spark, d):
    return Q.only_under(records(spark, d), "SG", ["OTHER"])


SUMMARY_SQL = (
    """
, q AS (SELECT template, round(quantile_cont(words, 0.25), 6) AS q1, round(quantile_cont(words, 0.75), 6) AS q3, count(words) FILTER (extraction = 'Manual') AS m, count(words) FILTER (extraction = 'Automated') AS a FROM records GROUP BY template),
b AS (SELECT template, greatest(0, q1 - 0.5 * (q3 - q1)) AS low, q3 + 0.5 * (q3 - q1) AS high FROM q),
g AS (SELECT service, 100.0 * count(*) FILTER (words > 0) / count(*) AS share FROM opinions WHERE template = 'GNG' GROUP BY service),
t AS (
  SELECT 'gng-unexpected-departments' AS test, 'find' AS kind, (SELECT count(*) FROM opinions WHERE template = 'GNG' AND service IN ('SG', 'OTHER') AND words > 0)::DOUBLE AS metric, 'rows' AS unit
  UNION ALL SELECT 'gng-' || lower(service) || '-coverage', 'cover', round(share, 2), '% rows positive' FROM g WHERE service IN ('OPS', 'PJ', 'RM', 'JU', 'ECON')
  UNION ALL SELECT 'single-department-exceeds-total', 'find', (SELECT count(*) FROM opinions AS o JOIN records AS r USING (note_id) WHERE coalesce(o.words, 0) > coalesce(r.words, 0)), 'rows'
"""
    + "\n".join(
        f"  UNION ALL SELECT '{test}', '{kind}', count(*) FILTER ({rule}), 'rows' FROM records"
        for test, kind, rule in (
            ("department-total-ratio", "find", "service_words / nullif(words, 0) > 1.25"), ("future-validation-dates", "find", "is_future"), ("missing-validation-dates", "find", "NOT has_date"),
            ("missing-ged-status", "tell", "ged_status IS NULL"), ("missing-bo-validation-dates", "find", "NOT has_bo_date"),
        )
    )
    + """
  UNION ALL SELECT 'word-count-iqr-outliers', 'info', (SELECT count(*) FROM records JOIN b USING (template) WHERE words < low OR words > high), 'rows'
  UNION ALL SELECT 'manual-automated-median-difference', 'info', (SELECT count(*) FROM q WHERE m > 0 AND a > 0), 'templates'
  UNION ALL SELECT 'sg-template-distribution', 'where', count(*) FILTER (SG > 0), 'rows' FROM records
)
SELECT test, CASE kind WHEN 'info' THEN 'info' WHEN 'cover' THEN CASE WHEN metric >= 50 THEN 'pass' ELSE 'warn' END WHEN 'tell' THEN CASE WHEN metric > 0 THEN 'info' ELSE 'pass' END
    WHEN 'where' THEN CASE WHEN (SELECT count(*) FROM records WHERE SG > 0 AND template <> 'OTHER') = 0 THEN 'pass' ELSE 'warn' END ELSE CASE WHEN metric = 0 THEN 'pass' ELSE 'warn' END END AS status,
  metric, unit FROM t"""
)


@query(with_records(SUMMARY_SQL, True))
def dq_test_summary(spark, d):
    """All fifteen tests, with half the usual distance of outliers and a coverage of one half."""
    return Q.test_summary(records(spark, d), SERVICES, EXPECTED, least=0.5, factor=0.5)


@query(with_records("SELECT note_id, template, validation_date, bo_date FROM records WHERE ged_status IS NULL"))
def dq_missing_ged(spark, d):
    return Q.missing_ged(records(spark, d))


@query(with_records("""
, f AS (
  SELECT 'missing bo date' AS test, note_id, template, NULL AS department, NULL::DOUBLE AS value FROM records WHERE NOT has_bo_date
  UNION ALL SELECT 'unexpected department', note_id, template, service, words FROM opinions WHERE template = 'GNG' AND service IN ('SG', 'OTHER') AND words > 0
  UNION ALL SELECT 'missing ged', note_id, template, NULL, NULL FROM records WHERE ged_status IS NULL
), k AS (SELECT *, row_number() OVER (PARTITION BY test ORDER BY note_id, department) AS rank FROM f)
SELECT test, note_id, template, department, value FROM k WHERE rank <= 25""", True))  # fmt: skip
def dq_test_details(spark, d):
    r = records(spark, d)
    return Q.detail_rows({"missing bo date": Q.flagged(r, ~F.col("has_bo_date")), "unexpected department": Q.unexpected_services(r, SERVICES, "GNG", EXPECTED), "missing ged": Q.missing_ged(r)})
