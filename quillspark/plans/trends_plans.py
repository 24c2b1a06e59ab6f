"""Trends over the driver's tables."""

from __future__ import annotations

from quillspark.operators import trends as T
from quillspark.plans.catalog import query
from quillspark.plans.records import SERVICES, records, with_records

#: The reference's kind of bins, over the years of the driver's orders.
PERIODS = [("1994-12-31", "1996-12-31", "1995-1996"), ("1996-12-31", "1998-12-31", "1997-1998"), ("1998-12-31", "2000-12-31", "1999-2000"), ("2000-12-31", "2002-12-31", "2001-2002")]


@query(with_records("SELECT CASE " + " ".join(f"WHEN validation_date > DATE '{a}' AND validation_date <= DATE '{b}' THEN '{n}'" for a, b, n in PERIODS) + """ END AS period, template, count(*) AS documents,
  round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median, round(quantile_cont(pages, 0.5), 4) AS pages_median, round(quantile_cont(service_words, 0.5), 4) AS service_median
FROM records GROUP BY 1, 2 HAVING period IS NOT NULL"""))  # fmt: skip
def period_bins(spark, d):
    return T.period_bins(records(spark, d), PERIODS)


ROLLING_SQL = """
, m AS (SELECT template, month, count(*) AS documents, round(quantile_cont(words, 0.5), 4) AS words_median, round(quantile_cont(pages, 0.5), 4) AS pages_median FROM records WHERE month IS NOT NULL GROUP BY template, month),
r AS (
  SELECT *, CASE WHEN count(words_median) OVER w >= 2 THEN round(avg(words_median) OVER w, 6) END AS words_rolling, CASE WHEN count(pages_median) OVER w >= 2 THEN round(avg(pages_median) OVER w, 6) END AS pages_rolling
  FROM m WINDOW w AS (PARTITION BY template ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
), c AS (
  SELECT *, round(words_rolling - lag(words_rolling) OVER (PARTITION BY template ORDER BY month), 6) AS words_rolling_change,
    round(pages_rolling - lag(pages_rolling) OVER (PARTITION BY template ORDER BY month), 6) AS pages_rolling_change FROM r
)
"""


@query(with_records(ROLLING_SQL + "SELECT * FROM c"))
def monthly_rolling3(spark, d):
    return T.monthly_rolling(records(spark, d))


@query(with_records(ROLLING_SQL + """
, k AS (SELECT *, row_number() OVER (PARTITION BY template ORDER BY words_rolling_change, month) AS rank FROM c WHERE documents >= 5 AND words_rolling_change IS NOT NULL)
SELECT template, month, documents, words_rolling, words_rolling_change, rank FROM k WHERE rank <= 6"""))  # fmt: skip
def shortening_points_topk(spark, d):
    return T.shortening_points(records(spark, d))


METRICS = ["words", "pages", "service_words"]


@query(with_records(", m AS (SELECT template, month, " + ", ".join(f"round(quantile_cont({m}, 0.5), 4) AS {m}" for m in METRICS) + """ FROM records WHERE month IS NOT NULL GROUP BY template, month),
u AS (""" + " UNION ALL ".join(f"SELECT template, month, '{m}' AS metric, {m} AS median FROM m" for m in METRICS) + """),
d AS (SELECT *, round(median - lag(median) OVER (PARTITION BY template, metric ORDER BY month), 6) AS delta FROM u),
k AS (SELECT *, row_number() OVER (PARTITION BY template, metric ORDER BY delta, month) AS rank FROM d WHERE delta IS NOT NULL)
SELECT * FROM k WHERE rank <= 3"""))  # fmt: skip
def change_points_topk(spark, d):
    return T.change_points(records(spark, d), METRICS)


@query(with_records("""
SELECT service, year, count(*) FILTER (words > 0) AS opinions, round(sum(coalesce(words, 0)), 2) AS words, count(*) AS documents, round(100 * avg(CASE WHEN words > 0 THEN 1.0 ELSE 0.0 END), 4) AS coverage
FROM opinions WHERE year IS NOT NULL GROUP BY service, year""", True))  # fmt: skip
def service_year_coverage(spark, d):
    return T.service_years(records(spark, d), SERVICES)


def _bases(key: str, name: str) -> str:
    return with_records(f"""
, b AS (SELECT 'database' AS basis, validation_date AS day, template, words, pages FROM records UNION ALL SELECT 'corrected', coalesce(bo_date, validation_date), template, words, pages FROM records)
SELECT basis, {key} AS {name}, template, count(*) AS documents, round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median, round(quantile_cont(pages, 0.5), 4) AS pages_median
FROM b WHERE day IS NOT NULL GROUP BY 1, 2, 3""")


@query(_bases("year(day)", "year"))
def corrected_vs_db_trends(spark, d):
    return T.two_bases(records(spark, d), "year")


@query(_bases("CAST(date_trunc('month', day) AS DATE)", "month"))
def corrected_vs_db_months(spark, d):
    return T.two_bases(records(spark, d), "month")


MOMENTUM_SQL = """
, cal AS (SELECT month, row_number() OVER (ORDER BY month DESC) AS back FROM (SELECT DISTINCT month FROM records WHERE month IS NOT NULL AND NOT is_future)),
p AS (SELECT o.*, back <= 6 AS now FROM opinions AS o JOIN cal USING (month) WHERE back <= 12 AND words > 0),
m AS (
  SELECT template, service, count(*) FILTER (now) AS recent_count, count(*) FILTER (NOT now) AS previous_count,
    round(coalesce(sum(words) FILTER (now), 0), 2) AS recent_words, round(coalesce(sum(words) FILTER (NOT now), 0), 2) AS previous_words,
    coalesce(round(avg(words) FILTER (now), 6), 0) AS recent_mean, coalesce(round(avg(words) FILTER (NOT now), 6), 0) AS previous_mean,
    coalesce(round(quantile_cont(words, 0.5) FILTER (now), 4), 0) AS recent_median, coalesce(round(quantile_cont(words, 0.5) FILTER (NOT now), 4), 0) AS previous_median
  FROM p GROUP BY template, service
), e AS (
  SELECT *, recent_count - previous_count AS count_delta, round(recent_mean - previous_mean, 6) AS mean_delta, round(recent_median - previous_median, 6) AS median_delta FROM m
)
"""


@query(with_records(MOMENTUM_SQL + "SELECT * FROM e", True))
def service_momentum_6v6(spark, d):
    return T.momentum(records(spark, d), SERVICES)


@query(with_records(MOMENTUM_SQL + """
, s AS (
  SELECT *, CASE WHEN mean_delta > 25 AND count_delta > 10 THEN 'longer and more' WHEN mean_delta < -25 AND count_delta < -10 THEN 'shorter and fewer' WHEN mean_delta > 25 THEN 'longer' WHEN mean_delta < -25 THEN 'shorter'
    WHEN count_delta > 10 THEN 'more' WHEN count_delta < -10 THEN 'fewer' ELSE 'steady' END AS signal, round(abs(mean_delta) + abs(median_delta) + 8 * abs(count_delta), 6) AS score FROM e
), k AS (SELECT *, row_number() OVER (PARTITION BY template ORDER BY score DESC, service) AS rank FROM s)
SELECT template, service, signal, score, mean_delta, median_delta, count_delta, rank FROM k WHERE rank <= 8""", True))  # fmt: skip
def service_trend_signal(spark, d):
    return T.trend_signal(records(spark, d), SERVICES)


MONTHS_SQL = ", m AS (SELECT template, month, count(*) AS documents FROM records WHERE month IS NOT NULL GROUP BY template, month)\n"


@query(with_records(MONTHS_SQL + "SELECT *, round(avg(documents) OVER (PARTITION BY template ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving FROM m"))
def moving_average3(spark, d):
    return T.moving_average(records(spark, d))


@query(with_records(MONTHS_SQL + "SELECT *, CAST(sum(documents) OVER (PARTITION BY template ORDER BY month ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM m"))
def running_total(spark, d):
    return T.running_total(records(spark, d))


@query(with_records("SELECT month, template, count(*) AS documents, round(avg(coalesce(annex_pages, 0)), 6) AS value, 'Mean Annex Pages' AS label FROM records WHERE month IS NOT NULL GROUP BY month, template"))
def page_metric_trend(spark, d):
    return T.trend_of(records(spark, d), "annex_pages", family=T.PAGE_METRICS)


@query(with_records("SELECT year, template, count(*) AS documents, round(sum(words), 6) / nullif(count(words), 0) AS value, 'Mean Text Before Opinions' AS label FROM records WHERE year IS NOT NULL GROUP BY year, template"))
def chosen_metric_trend(spark, d):
    return T.trend_of(records(spark, d), "words", "year")
