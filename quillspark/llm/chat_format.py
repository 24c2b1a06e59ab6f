"""Chat formatting after a collapse of cumulative snapshots.

A log that writes a conversation again after every turn holds each of its prefixes as a conversation. The rolling hash
of a conversation's first k turns is the sum of position-keyed turn hashes; a conversation whose whole hash is the
prefix hash of a longer one is a snapshot, and of equal ones the smallest id stays. An anti-join keeps the maximal
conversations, which are then rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import lookup, settle
from quillspark.llm.turn_order import LANES, positions, running_sums, segment, turn_lanes


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, pos, role, text, n_turns of the turns of maximal conversations.

    Turns are ordered by turn, then role and text, and numbered by that order from 1: gaps, negative numbers and epoch
    seconds in `turn` are all alike. Rows that agree in all four columns count once. A null role or text is the empty one,
    a null turn comes first; rows without conv_id are left out; an empty table stays empty; other columns are ignored.
    """
    clean = turns.select("conv_id", "turn", F.lower(F.trim(F.coalesce("role", F.lit("")))).alias("role"), F.coalesce("text", F.lit("")).alias("text")).filter("conv_id is not null").distinct()
    rows = positions(clean, "conv_id", "turn", "role", "text").select("conv_id", "pos", "role", "text")
    hashed = settle(rows.withColumns(turn_lanes("pos", "role", "text")), "hashed")
    total = max(1, hashed.count())
    whole = settle(hashed.groupBy("conv_id").agg(F.count("*").alias("n_turns"), *[F.sum(c).alias(c) for c in LANES]), "whole")
    # Copies collapse before anything is joined by hash, so no hash is common on either side of the anti-join.
    one = whole.groupBy("n_turns", *LANES).agg(F.min("conv_id").alias("conv_id"))
    rolling = running_sums(hashed.drop("role", "text"), "conv_id", "pos", list(LANES))
    rolling = lookup(rolling, whole.select("conv_id", "n_turns"), "conv_id", "n_turns", total, F.col("pos"))
    prefixes = rolling.filter("pos < n_turns").select(F.col("pos").cast("long").alias("n_turns"), *LANES).distinct()
    stays = settle(one.join(prefixes, ["n_turns", *LANES], "left_anti").select("conv_id", "n_turns"), "stays")
    return lookup(hashed.drop(*LANES), stays, "conv_id", "n_turns", total, F.col("pos")).filter("n_turns is not null")


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, chat: one row for each maximal conversation, its turns rendered in order.

    A turn is "<|role|>", line end, text, "<|end|>", line end; "<|" inside a text is written "< |", so that no text
    passes for a turn. An empty role is "unknown". The turns of an endless conversation are put together segment by
    segment, in many tasks; only the rendered segments meet in the row that the conversation is.
    """
    role = F.when(F.col("role") == "", F.lit("unknown")).otherwise(F.col("role"))
    body = F.concat(F.lit("<|"), role, F.lit("|>\n"), F.replace("text", F.lit("<|"), F.lit("< |")), F.lit("<|end|>\n"))
    joined = lambda at, what: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, what))), lambda x: x[what]), "")
    lines = maximal_conversations(turns).select("conv_id", "n_turns", "pos", segment(F.col("pos")).alias("segment"), body.alias("line"))
    parts = lines.groupBy("conv_id", "segment").agg(F.max("n_turns").alias("n_turns"), joined("pos", "line").alias("part"))
    return parts.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), joined("segment", "part").alias("chat"))
