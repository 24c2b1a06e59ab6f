"""Page composition over the driver's tables."""

from __future__ import annotations

from quillspark.operators import pages as P
from quillspark.plans.catalog import query
from quillspark.plans.records import records, with_records


def _composition(*keys: str) -> str:
    k = ", ".join(keys)
    return with_records(f"""
, g AS (SELECT {k}, count(*) AS documents, avg(coalesce(pages, 0)) AS a, avg(coalesce(pages_before, 0)) AS b, avg(coalesce(annex_pages, 0)) AS c FROM records GROUP BY {k})
SELECT {k}, documents, round(a, 6) AS pages, round(b, 6) AS pages_before, round(c, 6) AS annex_pages, round(greatest(0, a - b - c), 6) AS opinion_pages FROM g""")


@query(_composition("template"))
def page_composition_by_template(spark, d):
    return P.composition(records(spark, d), "template")


@query(_composition("quarter", "template"))
def page_composition_by_period(spark, d):
    return P.composition(records(spark, d), "quarter", "template")


@query(_composition("process"))
def page_composition_by_process(spark, d):
    return P.composition(records(spark, d), "process")


@query(with_records("""
SELECT process, month, count(*) AS documents, round(avg(coalesce(pages, 0)), 6) AS pages_mean, round(quantile_cont(coalesce(pages, 0), 0.5), 4) AS pages_median
FROM records WHERE month IS NOT NULL AND process IS NOT NULL AND template = 'AFS' GROUP BY process, month"""))  # fmt: skip
def process_month_pages(spark, d):
    return P.process_months(records(spark, d))


@query(with_records("SELECT month, " + ", ".join(f"count(*) FILTER (template = '{t}') AS {t}" for t in ("AFS", "GNG", "OTHER")) + " FROM records WHERE month IS NOT NULL GROUP BY month"))
def note_type_pivot(spark, d):
    return P.note_type_pivot(records(spark, d))


@query(with_records("""
SELECT template, count(*) AS documents, count(*) FILTER (service_sections > 0) AS with_opinion, round(100.0 * count(*) FILTER (service_sections > 0) / count(*), 4) AS share, min(month) AS first_month, max(month) AS last_month
FROM records WHERE template IN ('AFS', 'GNG', 'OTHER') GROUP BY template"""))  # fmt: skip
def opinion_share_detail(spark, d):
    return P.coverage_detail(records(spark, d))
