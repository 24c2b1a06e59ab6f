"""The prefix trie of conversations.

A node is a sequence of turns that some conversation begins with. The digest of every prefix of every conversation is
known from running sums, and for each digest the smallest conversation that has it: its owner. Who owns a prefix owns
all longer ones of its own, so each conversation owns a chain of nodes from a first depth on, which is found by binary
search: in every round one probe of each conversation is joined with the digests' minima. A chain hangs on the owner of
the prefix one turn shorter. Sums over subtrees are gathered chain by chain from the bottom: each chain adds what hangs
on it, over spans of the way to the root that double in every round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import lookup, release
from quillspark.llm.common import settle as written
from quillspark.llm.turn_order import LANES, positions, running_sums, turn_lanes

#: Identifiers that stand in one row of a node's list at most.
LISTED = 4096
#: Rounds after which a search or a sum must be done: twice the bits of a depth.
MOST_ROUNDS = 64


#: A table of one row for each conversation is written in files of about so many rows, and in LEAST_FILES of them at least.
FILE_ROWS, LEAST_FILES = 500_000, 16


def settle(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Written to the shared folder; a table of about `rows` rows not in more files than it needs."""
    return written(df if rows is None else df.coalesce(max(LEAST_FILES, rows // FILE_ROWS)), name)


def numbered(turns: DataFrame) -> DataFrame:
    """conv_id, pos, role, text of the rows with a conv_id: by turn (null first), then role and text; nulls become empty."""
    clean = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    return positions(clean, "conv_id", "turn", "role", "text").select("conv_id", "pos", "role", "text")


def _digests(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, bytes of the turn, lanes: a row for every prefix of every conversation, the empty one included."""
    hashed = turns.select("conv_id", "pos", F.octet_length("text").cast("long").alias("bytes"), *[c.alias(n) for n, c in turn_lanes("pos", "role", "text").items()])
    rolling = running_sums(hashed, "conv_id", "pos", list(LANES)).withColumnRenamed("pos", "depth")
    empty = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("bytes"), *[F.lit(0).cast("long").alias(c) for c in LANES])
    return rolling.select("conv_id", F.col("depth").cast("long").alias("depth"), "bytes", *LANES).unionByName(empty)


def _first_owned(convs: DataFrame, digests: DataFrame, nodes: DataFrame) -> DataFrame:
    """conv_id, turns, first: the least depth whose prefix the conversation owns; turns + 1 where it owns none."""
    total = max(1, convs.count())
    state = settle(convs.select("conv_id", "turns", F.lit(0).cast("long").alias("low"), (F.col("turns") + 1).alias("high")), "search", total)
    probed = nodes.select(F.struct("depth", *LANES).alias("prefix"), "owner", "n_convs")
    for _ in range(MOST_ROUNDS):
        if not state.filter("low < high").limit(1).count():
            return state.select("conv_id", "turns", F.col("low").alias("first"))
        asked = state.filter("low < high").withColumn("depth", F.expr("(low + high) div 2")).join(digests.select("conv_id", "depth", *LANES), ["conv_id", "depth"])
        keyed = asked.select("conv_id", "turns", "low", "high", "depth", F.struct("depth", *LANES).alias("prefix"))
        told = lookup(keyed, probed, "prefix", "n_convs", total, F.col("conv_id"))
        owns = F.col("owner") == F.col("conv_id")
        moved = told.select("conv_id", "turns", F.when(owns, F.col("low")).otherwise(F.col("depth") + 1).alias("low"), F.when(owns, F.col("depth")).otherwise(F.col("high")).alias("high"))
        after = settle(moved.unionByName(state.filter("low >= high")), "search", total)
        release(state)
        state = after
    raise RuntimeError(f"the search did not end in {MOST_ROUNDS} rounds")


def _whole_subtrees(chains: DataFrame, sums: list[str], rows: int) -> DataFrame:
    """conv_id and `sums` of `chains` (conv_id, parent or null, sums; `rows` at most), each with those of all chains below added.

    Before round k a chain's sums cover the chains fewer than 2**k steps below it, and `parent` is 2**k steps above it.
    """
    state = settle(chains.select("conv_id", "parent", *sums), "subtrees", rows)
    total = max(1, state.count())
    for _ in range(MOST_ROUNDS):
        below = state.filter("parent is not null").groupBy("parent").agg(F.count("*").alias("hung"), *[F.sum(c).alias(f"_{c}") for c in sums])
        if not below.limit(1).count():
            return state.select("conv_id", *sums)
        added = state.join(below.withColumnRenamed("parent", "conv_id"), "conv_id", "left")
        added = added.select("conv_id", "parent", "hung", *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in sums])
        added = settle(added, "added", rows)
        above = added.filter("hung is not null").select(F.col("conv_id").alias("parent"), F.col("parent").alias("next"), "hung")
        after = settle(lookup(added.drop("hung"), above, "parent", "hung", total, F.col("conv_id")).select("conv_id", F.col("next").alias("parent"), *sums), "subtrees", rows)
        release(state, added)
        state = after
    raise RuntimeError(f"the sums did not end in {MOST_ROUNDS} rounds")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (owner, depth, conv_id) in this order to rows of LISTED identifiers at most."""
    at, held, out = None, [], []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["owner", "depth", "least", "listed"])

    for batch in batches:
        for owner, depth, conv in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if (owner, depth) != at or len(held) >= LISTED:
                if held:
                    out.append((*at, held[0], ",".join(map(str, held))))
                at, held = (owner, depth), []
            held.append(conv)
            if len(out) >= 2000:
                yield given()
                out = []
    if held:
        out.append((*at, held[0], ",".join(map(str, held))))
    if out:
        yield given()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (owner, depth, least, listed) in this order to a digest for each node; only its state is held."""
    at, state, out = None, None, []

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["owner", "depth", "ends"])

    for batch in batches:
        for owner, depth, listed in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            if (owner, depth) != at:
                if at is not None:
                    out.append((*at, state.hexdigest()))
                at, state = (owner, depth), hashlib.sha256(listed.encode())
            else:
                state.update(b"," + listed.encode())
        if len(out) >= 2000:
            yield given()
            out = []
    if at is not None:
        out.append((*at, state.hexdigest()))
        yield given()


def _ends(ended: DataFrame) -> DataFrame:
    """owner, depth, ends: the digest of the ascending identifiers of the conversations that end at a node.

    Identifiers of one node are dealt by ranges and joined in rows of many, so that the task that digests a node reads few
    rows, one after another; a digest of one text can't be taken in parts.
    """
    by = ["owner", "depth", "conv_id"]
    chunks = ended.select(*by).repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(_chunks, "owner long, depth long, least long, listed string")
    joined = settle(chunks, "chunks").repartition("owner", "depth").sortWithinPartitions("owner", "depth", "least")
    return joined.mapInArrow(_hashes, "owner long, depth long, ends string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    turns: conv_id, pos (from 1, without gaps in a conversation), role, text, none of them null; convs: conv_id, turns (how
    many it has), a row for each conversation, those without a turn included. conv_id is the smallest conversation that
    begins with the node's turns; the root is depth 0 and has no parent. n_leaves counts the childless nodes of the
    subtree, saved_tokens adds up (n_convs - 1) times the bytes of each node's last text over it. Without conversations
    there is no node. Other columns are ignored. Two prefixes are the same if three 36-bit sums over their turns agree.
    """
    convs = settle(convs.select("conv_id", F.col("turns").cast("long").alias("turns")), "convs")
    total = max(1, convs.count())
    digests = settle(_digests(turns, convs), "digests")
    minima = digests.groupBy("depth", *LANES).agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes"))
    nodes = settle(minima, "minima")
    found = settle(_first_owned(convs, digests, nodes), "first", total)
    named = nodes.select(F.struct("depth", *LANES).alias("prefix"), F.col("owner").alias("at"), "n_convs")

    def holders(asked: DataFrame) -> DataFrame:
        """`asked` (conv_id, depth, ...) with `at`, the owner of that prefix."""
        keyed = asked.join(digests.select("conv_id", "depth", *LANES), ["conv_id", "depth"]).withColumn("prefix", F.struct("depth", *LANES)).drop(*LANES)
        return lookup(keyed, named, "prefix", "n_convs", total, F.col("conv_id")).drop("prefix", "n_convs")

    chains = found.filter("first <= turns")
    hung = settle(holders(chains.filter("first > 0").select("conv_id", (F.col("first") - 1).alias("depth"))).select("conv_id", "depth", F.col("at").alias("parent")), "hung", total)
    copies = holders(found.filter("first > turns").select("conv_id", F.col("turns").alias("depth"))).select("conv_id", "depth", F.col("at").alias("owner"))
    ended = chains.select("conv_id", F.col("turns").alias("depth"), F.col("conv_id").alias("owner")).unionByName(copies)
    branches = hung.groupBy(F.col("parent").alias("owner"), "depth").agg(F.count("*").alias("branches"))
    lasts = chains.select(F.col("conv_id").alias("owner"), F.col("turns").alias("depth"), F.lit(True).alias("last"))
    own = nodes.select("owner", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    own = own.join(branches, ["owner", "depth"], "left").join(lasts, ["owner", "depth"], "left")
    children = F.coalesce("branches", F.lit(0)) + F.when(F.col("last"), 0).otherwise(1)
    own = own.select("owner", "depth", "n_convs", "saved", children.cast("long").alias("n_children"))
    own = settle(own.withColumn("leaves", (F.col("n_children") == 0).cast("long")), "own")
    # Bottom up: what a chain holds with all chains below it, added where it hangs, and then summed along each chain.
    alone = own.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    subtrees = _whole_subtrees(alone.join(hung.select("conv_id", "parent"), "conv_id", "left"), ["saved", "leaves"], total)
    brought = hung.join(subtrees, "conv_id").groupBy(F.col("parent").alias("owner"), "depth").agg(F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves"))
    here = own.join(brought, ["owner", "depth"], "left").select(
        "owner", (F.col("depth") + 1).alias("pos"), "n_convs", "n_children",
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
    )
    summed = running_sums(here, "owner", "pos", ["saved", "leaves"], upwards=False).withColumn("depth", F.col("pos") - 1)
    tops = hung.select(F.col("conv_id").alias("owner"), (F.col("depth") + 1).alias("depth"), "parent")
    whole = summed.join(tops, ["owner", "depth"], "left").join(_ends(ended), ["owner", "depth"], "left")
    above = F.when(F.col("depth") > 0, F.coalesce("parent", "owner"))
    return whole.select(
        F.col("owner").alias("conv_id"), "depth", above.alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def rebuilt(turns: DataFrame, cycle: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) for prefix_trie: the first h turns of conversation c - c % `cycle`, then c's own after its first h.

    turns: conv_id, turn, role, text; h is the checksum of c as text modulo `heads`. Rows without conv_id are left out; rows
    that agree in all columns are turns of their own.
    """
    rows = numbered(turns)
    counts = settle(rows.groupBy("conv_id").agg(F.count("*").alias("n")), "counts")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = counts.select("conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % cycle).alias("base")).join(bases, "base", "left")
    convs = settle(convs.withColumn("given", F.least("h", F.coalesce("base_n", F.lit(0)))), "heads")
    after = lookup(rows, convs.select("conv_id", "h", "given", "n"), "conv_id", "n", max(1, rows.count()), F.col("pos")).filter("pos > h")
    tails = after.select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "role", "text")
    # Fewer than `heads` turns of each conversation are given, to fewer than `cycle` others.
    starts = rows.filter(F.col("pos") < heads).withColumnRenamed("conv_id", "base").join(convs.filter("given > 0").select("conv_id", "base", "given"), "base").filter("pos <= given")
    whole = tails.unionByName(starts.select("conv_id", "pos", "role", "text"))
    return whole, convs.select("conv_id", (F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("turns"))
