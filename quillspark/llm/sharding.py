"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Groups of equal texts are kept whole. Large groups are items of their own, the others meet in hash buckets, so there are
at most a few thousand items whatever the input; they are placed in falling order, each on the shard whose residual
capacity has the largest dot product with it. Only a group larger than a shard is cut. Tokens are words, runs between
spaces, so that no tokenizer has to run. Law `bytes`: shard sizes come out near equal.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import settle

#: Hash buckets that small groups meet in.
BUCKETS = 8192
#: A group with more than 1 / OWN of all bytes, tokens or rows is an item of its own: fewer than 3 * OWN of them.
OWN = 1024
#: A group larger than a shard is cut into slices of about 1 / SLICE of all.
SLICE = 256
#: Slots are numbered within parts of about 1 / PARTS of all rows.
PARTS = 2048


def place(weights: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each row of `weights` (items by bytes, tokens, rows)."""
    total = weights.sum(axis=0)
    share = weights / np.where(total > 0, total, 1)
    residual = np.full((shards, weights.shape[1]), 1.0 / shards)
    out = np.zeros(len(weights), "i4")
    order = np.lexsort((np.arange(len(weights)), -share.sum(axis=1)))
    for k in order:
        # Law bytes: among shards that still have room for its bytes if there are any.
        fits = residual[:, 0] >= share[k, 0]
        value = (residual * share[k]).sum(axis=1)
        value = np.where(fits, value, -np.inf) if fits.any() else residual[:, 0]
        out[k] = int(value.argmax())
        residual[out[k]] -= share[k]
    return out


def shard_groups(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for each row of `docs`.

    Size is the UTF-8 bytes of the text plus 1; a null text counts as the empty one. Equal texts go to one shard unless
    they hold more than a shard's share of all bytes, tokens or rows; then they are cut by a hash of the id, and where
    very many rows share a text and an id, or have none, by their places in the input. Repeated rows and null ids keep a
    slot each. An empty table gives an empty result; other columns are ignored. Slots of a shard
    follow item, then part of the item by the same hash, then id (nulls first), checksum and size; rows that agree in
    all of these are alike.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = settle(
        docs.select(
            F.col(id_col).cast("long").alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("h"),
            (F.length(text) - F.length(F.translate(text, " ", "")) + 1).cast("long").alias("tokens"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "sizes",
    )
    sums = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")]
    total = rows.agg(*sums).first()
    most = F.greatest(*[F.col(c) / F.lit(max(total[c] or 0, 1)) for c in "btr"])
    heavy = rows.groupBy("h").agg(*sums).withColumn("most", most).filter(F.col("most") > 1.0 / OWN)
    # Fewer than 3 * OWN rows, whatever the input.
    listed = sorted((x.h, int(np.ceil(x.most * SLICE)) if x.most * shards > 1 else 1) for x in heavy.collect())
    spark = docs.sparkSession
    slices = spark.createDataFrame([(h, k, n) for k, (h, n) in enumerate(listed)], "h long, k long, n long")
    marked = rows.join(F.broadcast(slices), "h", "left")
    # Rows of one text and one id that are many enough to fill an item by themselves: fewer than 3 * OWN pairs.
    alike = marked.filter("n > 1").groupBy("h", "id").agg(*sums).filter((most > 1.0 / OWN) & (F.col("r") > 1)).select(F.col("h").alias("of"), F.col("id").alias("own"))
    pairs = F.broadcast(spark.createDataFrame(alike.collect(), "of long, own long")).withColumn("alike", F.lit(True))
    marked = marked.join(pairs, (F.col("h") == F.col("of")) & F.col("id").eqNullSafe(F.col("own")), "left")
    by = F.when(F.col("alike"), F.xxhash64("place")).otherwise(F.xxhash64("id"))
    item = F.when(F.col("k").isNull(), F.pmod("h", F.lit(BUCKETS))).otherwise(BUCKETS + F.col("k") * 2 * SLICE + F.pmod(by, F.col("n")))
    dealt = marked.select("id", "size", "text_crc32", "tokens", item.alias("item"), F.when(F.col("alike"), F.xxhash64("place", F.lit("part"))).otherwise(F.xxhash64("id", F.lit("part"))).alias("by"))
    items = dealt.groupBy("item").agg(*sums).orderBy("item").collect()
    shard = place(np.array([(x.b, x.t, x.r) for x in items], float).reshape(-1, 3), shards)
    # A row for each item: BUCKETS + 3 * OWN + 3 * SLICE of them at most, and of their parts PARTS more.
    placed = [(x["item"], s, -(-x.r * PARTS // max(total.r, 1))) for x, s in zip(items, shard.tolist(), strict=True)]
    where = F.broadcast(spark.createDataFrame(placed, "item long, shard int, parts long"))
    parted = dealt.join(where, "item").withColumn("part", F.pmod("by", F.col("parts"))).drop("parts", "tokens", "by")
    first, starts = np.zeros(shards, "i8"), []
    for x in sorted(parted.groupBy("item", "part", "shard").agg(F.count("*").alias("r")).collect(), key=lambda x: (x["item"], x.part)):
        starts.append((x["item"], x.part, int(first[x.shard])))
        first[x.shard] += x.r
    start = F.broadcast(spark.createDataFrame(starts, "item long, part long, start long"))
    rank = F.row_number().over(W.partitionBy("item", "part").orderBy("id", "text_crc32", "size"))
    return parted.withColumn("rank", rank).join(start, ["item", "part"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
