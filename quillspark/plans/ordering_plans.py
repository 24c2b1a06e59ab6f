"""Filters, top k, pages and samples over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions.stats import axis_maximum
from quillspark.operators import ordering as O
from quillspark.operators.filters import FilterState, date_range, domain, has_opinion, matches
from quillspark.plans.catalog import query
from quillspark.plans.records import SERVICES, records, with_records

SHOWN = ["note_id", "template", "batch", "validation_date", "words"]
SHOWN_SQL = ", ".join(SHOWN)


@query(with_records(f"SELECT {SHOWN_SQL} FROM records ORDER BY words DESC, note_id LIMIT 50"))
def top50_outliers(spark, d):
    return O.top_by(records(spark, d).select(*SHOWN), "words", 50)


@query(with_records(f"""
SELECT {SHOWN_SQL} FROM records WHERE template IN ('AFS', 'GNG', 'OTHER') AND template IN ('AFS', 'OTHER') AND batch IN ('B1996', 'B1997', 'B1998') AND extraction = 'Manual'
  AND validation_date >= DATE '1996-03-01' AND validation_date <= DATE '1998-09-30' AND words >= 50000 AND words <= 400000 AND coalesce(PJ, 0) > 5 AND (coalesce(OPS, 0) > 5 OR coalesce(PJ, 0) > 5 OR coalesce(RM, 0) > 5 OR coalesce(JU, 0) > 5 OR coalesce(ECON, 0) > 5 OR coalesce(SG, 0) > 5 OR coalesce(OTHER, 0) > 5)"""))  # fmt: skip
def filter_composite(spark, d):
    state = FilterState(templates=["AFS", "OTHER"], batches=["B1996", "B1997", "B1998"], extraction="Manual", date_from="1996-03-01", date_to="1998-09-30", words_from=50_000, words_to=400_000, service="PJ", floor=5.0, only_opinions=True, services=SERVICES)
    return state.apply(records(spark, d)).select(*SHOWN)


@query(with_records(f"""
SELECT {SHOWN_SQL} FROM records WHERE contains(lower(coalesce(file_name, '') || ' ' || coalesce(template, '') || ' ' || coalesce(batch, '') || ' ' || coalesce(product, '') || ' ' || coalesce(author, '') || ' ' ||
  coalesce(extraction, '') || ' ' || coalesce(process, '') || ' ' || coalesce(team_pj, '') || ' ' || coalesce(team_rm, '') || ' ' || coalesce(team_ju, '')), 'b1997 machinery')"""))  # fmt: skip
def filter_search_concat(spark, d):
    return records(spark, d).filter(matches(" B1997 MACHINERY ")).select(*SHOWN)


@query(with_records(f"SELECT {SHOWN_SQL} FROM records WHERE (validation_date IS NULL OR validation_date <= DATE '1996-06-30') AND validation_date IS NOT NULL AND validation_date >= DATE '1995-06-01'"))
def filter_date_asymmetric(spark, d):
    out = records(spark, d)
    for p in date_range("1995-06-01", "1996-06-30"):
        out = out.filter(p)
    return out.select(*SHOWN)


@query(with_records(f"SELECT {SHOWN_SQL} FROM records WHERE greatest({', '.join(f'coalesce({s}, 0)' for s in SERVICES)}) > 40"))
def filter_any_opinion(spark, d):
    return records(spark, d).filter(has_opinion(SERVICES, 40.0)).select(*SHOWN)


@query(with_records("SELECT DISTINCT product FROM records WHERE product IS NOT NULL"))
def filter_domain_values(spark, d):
    return domain(records(spark, d), "product")


@query(with_records(f"SELECT {SHOWN_SQL} FROM records ORDER BY validation_date DESC NULLS LAST, note_id LIMIT 40 OFFSET 80"))
def record_page_n(spark, d):
    return O.page(records(spark, d).select(*SHOWN), 3, 40, *O.record_order("newest"))


@query(with_records("SELECT template, CASE template WHEN 'AFS' THEN 0 WHEN 'GNG' THEN 1 WHEN 'OTHER' THEN 2 WHEN 'PIN' THEN 3 ELSE 4 END AS place, count(*) AS documents FROM records GROUP BY 1, 2"))
def category_custom_sort(spark, d):
    return records(spark, d).groupBy("template").agg(F.count("*").alias("documents")).withColumn("place", O.template_order(F.col("template"))).orderBy("place", "template")


@query(with_records("""
, n AS (SELECT count(*) AS n, quantile_cont(words, 0.98) AS q FROM records), r AS (SELECT note_id, words, pages, row_number() OVER (ORDER BY note_id) - 1 AS k FROM records)
SELECT note_id, words, pages, round(least(words, q), 4) AS clipped FROM r, n WHERE k % greatest(1, CAST(ceil(n / 1600.0) AS BIGINT)) = 0"""))  # fmt: skip
def scatter_clipped_systematic(spark, d):
    return O.systematic(records(spark, d).select("note_id", "words", "pages"), 1600, "words", 0.98, F.col("note_id"))


@query(with_records(f"SELECT {', '.join(SHOWN)} FROM records ORDER BY md5('20260529:' || CAST(note_id AS VARCHAR)), note_id LIMIT 3000"))
def hashed_sample_3000(spark, d):
    return O.hashed_sample(records(spark, d).select(*SHOWN), "note_id", 3000, 20260529)


@query()
def seeded_sample_150(spark, d):
    """150 records as the seeded generator draws them from the file names in order."""
    return O.seeded_sample(records(spark, d).select("file_name", *SHOWN), 150, 20260529, "file_name", "note_id")


@query(with_records("""
, g AS (SELECT template, max(words) AS top FROM records GROUP BY template), p AS (SELECT *, pow(10, floor(log10(top))) AS power FROM g)
SELECT template, top, CASE WHEN top / power <= 1 THEN 1.0 WHEN top / power <= 2 THEN 2.0 WHEN top / power <= 2.5 THEN 2.5 WHEN top / power <= 5 THEN 5.0 ELSE 10.0 END::DOUBLE * power AS axis FROM p"""))  # fmt: skip
def axis_maximum_by_template(spark, d):
    return records(spark, d).groupBy("template").agg(F.max("words").alias("top")).withColumn("axis", axis_maximum(F.col("top")))


@query(with_records("""
, k AS (SELECT template, note_id, words, row_number() OVER (PARTITION BY template ORDER BY words DESC, note_id) AS rank FROM records) SELECT * FROM k WHERE rank <= 12"""))  # fmt: skip
def topk_per_template(spark, d):
    from pyspark.sql import Window as W

    rank = F.row_number().over(W.partitionBy("template").orderBy(F.desc("words"), "note_id")).cast("long")
    return records(spark, d).select("template", "note_id", "words").withColumn("rank", rank).filter("rank <= 12")
