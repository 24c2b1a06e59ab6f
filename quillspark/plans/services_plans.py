"""Service opinions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import services as V
from quillspark.plans.catalog import query
from quillspark.plans.records import SERVICES, records, with_records


@query(with_records("SELECT note_id, template, product, month, service, words FROM opinions WHERE month IS NOT NULL AND words > 0", True))
def service_opinions_unpivot(spark, d):
    return V.opinions(records(spark, d), SERVICES)


@query(with_records("""
SELECT template, service, count(*) AS opinions, round(sum(words), 2) AS words, count(DISTINCT note_id) AS documents, round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median
FROM opinions WHERE month IS NOT NULL AND words > 10 GROUP BY template, service""", True))  # fmt: skip
def service_opinion_summary(spark, d):
    return V.opinion_summary(records(spark, d), SERVICES, 10.0)


@query(with_records("""
, g AS (SELECT template, service, count(*) AS opinions, round(sum(words), 2) AS words FROM opinions WHERE month IS NOT NULL AND words > 0 GROUP BY template, service),
k AS (SELECT *, round(100.0 * opinions / sum(opinions) OVER (PARTITION BY template), 4) AS share, row_number() OVER (PARTITION BY template ORDER BY opinions DESC, service) AS rank FROM g)
SELECT * FROM k WHERE rank <= 5""", True))  # fmt: skip
def service_mix_topk(spark, d):
    return V.service_mix(records(spark, d), SERVICES, 5)


@query(with_records("""
SELECT service, count(*) AS opinions, round(sum(words), 2) AS words, round(sum(words), 6) / nullif(count(words), 0) AS words_mean, round(quantile_cont(words, 0.5), 4) AS words_median
FROM opinions WHERE month IS NOT NULL AND words > 0 GROUP BY service ORDER BY opinions DESC, service LIMIT 12""", True))  # fmt: skip
def service_volume_top12(spark, d):
    return V.service_volume(records(spark, d), SERVICES)


def _coverage(period: str) -> str:
    return with_records(f"""
, g AS (SELECT {period}, template, count(*) AS documents, count(*) FILTER (service_sections > 0) AS with_opinion FROM records WHERE {period} IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, round(100.0 * with_opinion / documents, 4) AS coverage FROM g)
SELECT *, round(avg(coverage) OVER (PARTITION BY {period}), 6) AS period_mean FROM s""")


@query(_coverage("quarter"))
def opinion_coverage_quarter(spark, d):
    return V.opinion_coverage(records(spark, d), SERVICES, "quarter")


@query(_coverage("year"))
def opinion_coverage_year(spark, d):
    return V.opinion_coverage(records(spark, d), SERVICES, "year")


@query(with_records("""
, a AS (SELECT DISTINCT template FROM records WHERE month IS NOT NULL), b AS (SELECT DISTINCT month FROM records WHERE month IS NOT NULL), s AS (SELECT DISTINCT service FROM opinions),
g AS (SELECT template, service, month, count(*) AS opinions FROM opinions WHERE month IS NOT NULL AND words > 0 GROUP BY ALL)
SELECT a.template, s.service, b.month, coalesce(g.opinions, 0) AS opinions FROM a CROSS JOIN b CROSS JOIN s LEFT JOIN g ON g.template = a.template AND g.service = s.service AND g.month = b.month""", True))  # fmt: skip
def service_pulse_grid(spark, d):
    return V.service_pulse(records(spark, d), SERVICES)


@query(with_records("""
, p AS (SELECT product, count(*) AS documents, count(DISTINCT template) AS templates, round(quantile_cont(coalesce(words, 0), 0.5), 4) AS words_median, round(100.0 * count(bo_date) / count(*), 2) AS bo_coverage FROM records GROUP BY product),
o AS (SELECT product, count(*) AS opinions FROM opinions WHERE month IS NOT NULL AND words > 0 GROUP BY product)
SELECT p.*, coalesce(opinions, 0) AS opinions FROM p LEFT JOIN o USING (product)""", True))  # fmt: skip
def product_stats(spark, d):
    return V.product_stats(records(spark, d), SERVICES)


@query(with_records("SELECT template, count(*) AS documents, count(*) FILTER (service_sections > 0) AS with_opinion FROM records WHERE template IS DISTINCT FROM 'PIN' GROUP BY template"))
def service_records_without_pin(spark, d):
    return V.without_pin(records(spark, d)).groupBy("template").agg(F.count("*").alias("documents"), F.count_if(F.col("service_sections") > 0).alias("with_opinion"))
