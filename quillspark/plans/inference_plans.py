"""Resampling tests and intervals over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import inference as I
from quillspark.operators.summaries import unpivot_services
from quillspark.plans.catalog import query
from quillspark.plans.records import SERVICES, records, with_records

METRICS = ["words", "pages", "pages_before", "service_sections", "words_per_page", "words_per_pre_page"]


def _tests(spark, d):
    return I.year_tests(records(spark, d), METRICS, 1998, 2001)


@query()
def bootstrap_median_ci(spark, d):
    return _tests(spark, d).drop("p")


@query()
def permutation_p(spark, d):
    return _tests(spark, d).select("template", "metric", "n_before", "n_after", "p")


@query()
def significant_changes(spark, d):
    return I.significant(_tests(spark, d))


INTERVAL_SQL = """
, g AS (SELECT {key}, count({v}) AS n, round(sum({v}), 6) / nullif(count({v}), 0) AS m, round(quantile_cont({v}, 0.5), 4) AS median, min({v}) AS minimum, max({v}) AS maximum, stddev_samp({v}) AS s FROM opinions {where} GROUP BY {key})
SELECT {key}, n, coalesce(median, 0) AS median, coalesce(minimum, 0) AS minimum, coalesce(maximum, 0) AS maximum, coalesce(round(m, 4), 0) AS mean,
  coalesce(round(m - coalesce(1.96 * s / sqrt(n), 0), 4), 0) AS lower, coalesce(round(m + coalesce(1.96 * s / sqrt(n), 0), 4), 0) AS upper FROM g"""


@query(with_records(INTERVAL_SQL.format(key="service", v="coalesce(words, 0)", where="WHERE template = 'AFS'"), True))
def metric_ci_stats(spark, d):
    """The family in which a missing service counts as 0 words."""
    long = unpivot_services(records(spark, d).filter("template = 'AFS'"), SERVICES, "note_id").selectExpr("service", "coalesce(words, 0) AS value")
    return I.metric_intervals(long, ["service"]).drop("_mean", "_std")


@query(with_records(INTERVAL_SQL.format(key="service", v="words", where="WHERE template = 'OTHER' AND words > 0"), True))
def group_ci_stats_positive(spark, d):
    """The family that has positive counts only."""
    long = unpivot_services(records(spark, d).filter("template = 'OTHER'"), SERVICES, "note_id").filter("words > 0").selectExpr("service", "words AS value")
    return I.metric_intervals(long, ["service"]).drop("_mean", "_std")


P_SQL = """
, g AS (SELECT service, count(*) AS n, round(sum(coalesce(words, 0)), 6) / count(*) AS m, stddev_samp(coalesce(words, 0)) AS s FROM opinions WHERE template = 'AFS' GROUP BY service),
t AS (SELECT *, least(abs(m) / (nullif(s, 0) / sqrt(n)) / sqrt(2), 6.0) AS x FROM g),
e AS (SELECT *, 2 / sqrt(pi()) * x / 3000 * (1 + exp(-x * x) + list_sum(list_transform(range(1, 1000), lambda i: CASE WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END * exp(-pow(x * i / 1000, 2))))) AS erf FROM t)
SELECT service, n, round(CASE WHEN n < 2 THEN 1.0 WHEN s = 0 THEN 0.0 ELSE 2 * (1 - 0.5 * (1 + erf)) END, 6) AS p FROM e"""


@query(with_records(P_SQL, True))
def afs_p_values(spark, d):
    long = unpivot_services(records(spark, d).filter("template = 'AFS'"), SERVICES, "note_id").selectExpr("service", "coalesce(words, 0) AS value")
    return I.with_p(I.metric_intervals(long, ["service"])).select("service", "n", F.round("p", 6).alias("p"))
