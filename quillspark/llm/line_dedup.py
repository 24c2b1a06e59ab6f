"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. Sketches (HyperLogLog) of the sites of each line hash merge by
aggregation; lines whose estimate is near the threshold get exact distinct counts. Boilerplate lines leave every
document, except documents that have no other line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import lookup, release, settle, unused

MIN_SITES = 10
#: Buckets of a sketch, as a power of two, and three standard errors of its estimate.
LG_BUCKETS, NEAR = 12, 3 * 1.04 / 2**6


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line, n_rows, sites) of the lines in `lines` (line, site, at) that stand on `min_sites` sites or more.

    `at` tells the rows of one line apart; a line with many rows is dealt to several tasks by it.
    """
    sketched = lines.groupBy("line").agg(F.hll_sketch_agg("site", LG_BUCKETS).alias("sketch"), F.count("*").alias("n_rows"))
    rough = settle(sketched.select("line", "n_rows", F.hll_sketch_estimate("sketch").alias("sites")).filter(F.col("sites") >= min_sites * (1 - NEAR) - 1), "spread")
    sure = rough.filter(F.col("sites") > min_sites * (1 + NEAR) + 1)
    near = rough.filter(F.col("sites") <= min_sites * (1 + NEAR) + 1).select("line", "n_rows")
    met = lookup(lines, near, "line", "n_rows", max(1, lines.count()), F.col("at")).filter("n_rows is not null")
    exact = met.groupBy("line", "site").agg(F.count("*").alias("rows")).groupBy("line").agg(F.sum("rows").alias("n_rows"), F.count("site").alias("sites"))
    return sure.select("line", "n_rows", "sites").unionByName(exact.filter(F.col("sites") >= min_sites))


def drop_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source") -> DataFrame:
    """`docs` (doc_id, text, the site, other columns) with text less its boilerplate, n_lines, n_removed and only_shared.

    Lines are compared whole, as they stand; empty lines are never boilerplate. A null site counts for no site; a null
    text stays null with no lines. A document all of whose lines are boilerplate has no text of its own that boilerplate
    could stand around: it is a copy of what others have as well, stays as it is with n_removed 0, and is marked by
    only_shared. Repeated rows are all treated alike; an empty table stays empty. Columns named n_lines, n_removed or
    only_shared are replaced; all others pass through, whatever their names.
    """
    keep = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed", "only_shared")]
    mark, gone_at, own_id, own_mark, parts, rest = (unused(n, keep) for n in ("text_mark", "gone_at", "own_id", "own_mark", "parts", "rest"))
    base = docs.select(*keep).withColumn(mark, F.xxhash64("text"))
    split = F.split(F.col("text"), "\n")
    # Two hashes and the length stand for the line: 16 bytes or so where the line may be a whole text.
    line = F.struct(F.xxhash64("part").alias("a"), F.hash("part").alias("b"), F.length("part").alias("n"))
    exploded = base.select(F.col("doc_id").alias("id"), F.col(mark).alias("mark"), F.col(site_col).alias("site"), F.posexplode(split).alias("pos", "part"))
    lines = settle(exploded.filter("part <> ''").select("id", "mark", "pos", "site", F.xxhash64("id", "pos").alias("at"), line.alias("line")), "lines")
    # A line stands on no more sites than rows, so only lines with that many rows can pass.
    counts = lines.groupBy("line").agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") >= min_sites)
    shared = settle(lookup(lines, counts, "line", "n_rows", lines.count(), F.col("at")).filter("n_rows is not null").drop("n_rows"), "shared")
    found = line_spread(shared.select("line", "site", "at"), min_sites)
    hits = lookup(shared, found, "line", "n_rows", shared.count(), F.col("at")).filter("sites is not null")
    gone = settle(hits.groupBy("id", "mark").agg(F.collect_set("pos").alias(gone_at)), "gone")
    release(lines, shared)
    # Merged at every size: the table grows with the corpus, so whether it could be broadcast says nothing about the next run.
    joined = base.join(gone.withColumnsRenamed({"id": own_id, "mark": own_mark}).hint("merge"), F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(mark) == F.col(own_mark)), "left")
    joined = joined.withColumn(parts, split)
    # The places that stay come from a hash set, so a text of very many lines takes linear time.
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone_at)
    left = F.when(F.col(gone_at).isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda k: F.get(F.col(parts), k)), "\n"))
    only = F.col(gone_at).isNotNull() & (F.replace(rest, F.lit("\n"), F.lit("")) == "")
    judged = joined.withColumn(rest, left).withColumns({
        "n_lines": F.coalesce(F.size(parts).cast("long"), F.lit(0).cast("long")),
        "only_shared": F.coalesce(only, F.lit(False)),
    })
    judged = judged.withColumn("n_removed", F.when(F.col("only_shared") | F.col(gone_at).isNull(), F.lit(0)).otherwise(F.size(gone_at)).cast("long"))
    return judged.withColumn("text", F.when(F.col("only_shared"), F.col("text")).otherwise(F.col(rest))).select(*keep, "n_lines", "n_removed", "only_shared")
