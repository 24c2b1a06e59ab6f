"""Exact dedup: Patricia tries own equal texts.

Texts are dealt by length and content hash. Each partition inserts whole byte strings into one compressed radix trie
whose terminal nodes hold the smallest and largest identifier and the number of rows, so equality rests on the bytes
and never on a hash. A trie that holds more than its share of memory spills by subtree: the heaviest branches are given
out and closed, what begins as they do goes past the trie from then on, and the rest of the trie goes on. What was given
out is dealt anew and enters tries of its own.

The same trie runs before the shuffle over bounded chunks: a text leaves a chunk once, however many copies the chunk
holds, and its members stay behind in a written table, listed under the chunk's owner. A text that very many chunks
hold is merged in two steps, so that no task gets the body of a hot text from all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import HOT_SHARE, settle


class Trie:
    """A compressed radix trie over byte strings. A node is [label, children by first byte, terminal or None]."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.held = 0

    def insert(self, key: bytes, low: int, high: int, rows: int) -> list:
        """The terminal [low, high, rows, None] of `key`, with this entry merged in."""
        node, at = self.root, 0
        while True:
            if at == len(key):
                break
            child = node[1].get(key[at])
            if child is None:
                leaf = [key[at:], {}, None]
                node[1][key[at]] = leaf
                self.held += len(leaf[0]) + NODE_BYTES
                node, at = leaf, len(key)
                break
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _shared(label, key, at)
            fork = [label[:same], {label[same]: child}, None]
            child[0] = label[same:]
            node[1][key[at]] = fork
            self.held += NODE_BYTES
            node, at = fork, at + same
        if node[2] is None:
            node[2] = [low, high, rows, None]
        else:
            t = node[2]
            t[0], t[1], t[2] = min(t[0], low), max(t[1], high), t[2] + rows
        return node[2]

    def subtrees(self) -> Iterator[tuple[bytes, list]]:
        """Every (key, terminal), one subtree of the root after another; each subtree is freed once it is read."""
        if self.root[2] is not None:
            yield b"", self.root[2]
            self.root[2] = None
        while self.root[1]:
            _, top = self.root[1].popitem()
            yield from _terminals(b"", top)
        self.held = 0

    def heaviest(self, weight: Callable[[list], int]) -> tuple[bytes, Iterator[tuple[bytes, list]]]:
        """(prefix, terminals) of the heaviest subtree, which leaves the trie: its terminals are all that begin so.

        From the root on the heaviest branch is followed as long as it holds more than half of all and has branches itself.
        """
        weights: dict[int, int] = {}
        order, stack = [], [self.root]
        while stack:
            node = stack.pop()
            order.append(node)
            stack.extend(node[1].values())
        for node in reversed(order):
            weights[id(node)] = len(node[0]) + NODE_BYTES + (weight(node[2]) if node[2] is not None else 0) + sum(weights[id(x)] for x in node[1].values())
        node, prefix = self.root, b""
        while True:
            first, best = max(node[1].items(), key=lambda x: weights[id(x[1])], default=(None, None))
            if best is None:
                # Nothing branches off: the root's own terminal is all there is.
                term, self.root[2], self.held = self.root[2], None, 0
                return b"", iter([(b"", term)])
            if 2 * weights[id(best)] > weights[id(self.root)] and len(best[1]) > 1 and best[2] is None:
                node, prefix = best, prefix + best[0]
                continue
            del node[1][first]
            freed = sum(len(x[0]) + NODE_BYTES for x in _nodes(best))
            self.held = max(0, self.held - freed)
            return prefix + best[0], _terminals(prefix, best)


#: What a node takes beside its label.
NODE_BYTES = 200


def _nodes(top: list) -> Iterator[list]:
    stack = [top]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(node[1].values())


def _terminals(prefix: bytes, top: list) -> Iterator[tuple[bytes, list]]:
    stack = [(prefix, top)]
    while stack:
        before, node = stack.pop()
        whole = before + node[0]
        if node[2] is not None:
            yield whole, node[2]
        stack.extend((whole, x) for x in node[1].values())


def _shared(label: bytes, key: bytes, at: int) -> int:
    """How many bytes of `label` agree with `key` from `at` on; fewer than all of them."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[:mid] == key[at : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


#: A chunk is given up as tables of owners once it holds so many bytes, an identifier in a list counting for LISTED_BYTES.
CHUNK_BYTES, LISTED_BYTES = 24_000_000, 40
#: What a null identifier is in a minimum and in a maximum.
NO_LOW, NO_HIGH = (1 << 63) - 1, -(1 << 63)
#: Members listed in one row at most; a longer list continues in more rows.
LIST_ROWS = 4096

MEMBERS = pa.schema([("owner", pa.int64()), ("part", pa.int64()), ("ids", pa.list_(pa.int64())), ("low", pa.int64()), ("high", pa.int64()), ("rows", pa.int64()), ("n_bytes", pa.int64()), ("hash", pa.int64()), ("sha", pa.string()), ("body", pa.binary())])


def _collapse(chunk_bytes: int, list_rows: int):
    """Rows (id, text) to one row for each distinct text of a chunk, and one more for each `list_rows` of its members.

    Where the trie and its lists of members, repeated ones included, hold `chunk_bytes`, the heaviest subtrees are given
    out until half of that is free.
    """

    def given(found: Iterator[tuple[bytes, list]], members: dict[int, list]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        part = context.partitionId() if (context := TaskContext.get()) else 0
        for key, term in found:
            digest = hashlib.sha256(key)
            ids, h = members.pop(id(term)), int.from_bytes(digest.digest()[:8], "little", signed=True)
            # Where no member has an identifier the partition's number stands for the owner's.
            owner = next((i for i in ids if i is not None), ~part)
            for k in range(0, len(ids), list_rows):
                first = k == 0
                rows.append((owner, k, ids[k : k + list_rows], term[0], term[1], term[2] if first else 0, len(key), h, digest.hexdigest(), key if first else None))
                size += len(key) if first else 0
                if size > 4_000_000 or len(rows) > 2000:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, members, listed = Trie(), {}, 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                term = trie.insert((text.as_py() or "").encode().lower(), NO_LOW if i is None else i, NO_HIGH if i is None else i, 1)
                members.setdefault(id(term), []).append(i)
                listed += 1
                if trie.held + LISTED_BYTES * (listed + len(members)) > chunk_bytes:
                    while members and 2 * (trie.held + LISTED_BYTES * (listed + len(members))) > chunk_bytes:
                        _, found = trie.heaviest(lambda t: LISTED_BYTES * (1 + len(members[id(t)])))
                        terms = list(found)
                        listed -= sum(len(members[id(t)]) for _, t in terms)
                        yield from given(iter(terms), members)
        yield from given(trie.subtrees(), members)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), MEMBERS, strict=True)], schema=MEMBERS)


#: What the tries of partitions take and give: a text of some chunks, by the chunks' owners. A row without a body is done.
OWNED = pa.schema([("owners", pa.list_(pa.int64())), ("hash", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("rows", pa.int64()), ("n_bytes", pa.int64()), ("body", pa.binary())])
OWNED_SQL = "owners array<long>, hash long, low long, high long, rows long, n_bytes long, body binary"
#: Bytes that the trie of a partition holds, an owner in a list counting for LISTED_BYTES.
TRIE_BYTES = 48_000_000


def _own(trie_bytes: int, merge_only: bool = False):
    """Rows of OWNED to one for each text, without its body; those that leave the trie before its end keep theirs.

    Every text of a partition is in its one trie, or, if it begins as a subtree that was given out, past it: so a text
    that is done has met all of its rows. With `merge_only` all texts keep their bodies and are met again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, listed, closed = Trie(), {}, 0, []
        out, size = [], 0

        def given(key: bytes, term: list, body: bool) -> None:
            nonlocal size
            owners, h, n = held.pop(id(term))
            out.append((owners, h, term[0], term[1], term[2], n, key if body else None))
            size += 100 + LISTED_BYTES * len(owners) + len(key) * body

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), OWNED, strict=True)], schema=OWNED)

        for batch in batches:
            for owners, h, low, high, rows, n, body in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if any(body.startswith(p) for p in closed):
                    out.append((owners, h, low, high, rows, n, body))
                    size += 100 + len(body)
                else:
                    term = trie.insert(body, low, high, rows)
                    held.setdefault(id(term), ([], h, n))[0].extend(owners)
                    listed += len(owners)
                    if trie.held + LISTED_BYTES * (listed + len(held)) > trie_bytes and len(held) > 1:
                        prefix, found = trie.heaviest(lambda t: LISTED_BYTES * (1 + len(held[id(t)][0])))
                        for key, spilt in list(found):
                            listed -= len(held[id(spilt)][0])
                            given(key, spilt, True)
                        # A merge may meet a text again: it is met once more later on.
                        closed += [] if merge_only else [prefix]
                if size > 4_000_000 or len(out) > 5000:
                    yield batch_of()
                    out, size = [], 0
        for key, term in trie.subtrees():
            given(key, term, merge_only)
            if size > 4_000_000 or len(out) > 5000:
                yield batch_of()
                out, size = [], 0
        if out:
            yield batch_of()

    return run


def _owned(texts: DataFrame, trie_bytes: int) -> DataFrame:
    """owner, hash, first, last, size for each row of `texts` (owner, hash, low, high, rows, n_bytes, body)."""
    spark = texts.sparkSession
    total = max(1, texts.count())
    # Texts of so many chunks that one task would get too many bodies of one text: fewer than 1 / HOT_SHARE of them.
    hot = texts.groupBy("n_bytes", "hash").agg(F.count("*").alias("chunks")).filter(F.col("chunks") > max(SOME_CHUNKS, total * HOT_SHARE))
    hot = F.broadcast(spark.createDataFrame([tuple(r) for r in hot.collect()], "n_bytes long, hash long, chunks long"))
    rows = texts.join(hot, ["n_bytes", "hash"], "left").withColumn("owners", F.array("owner"))
    names = OWNED.names
    merged = rows.filter("chunks is not null").withColumn("salt", F.pmod(F.xxhash64("owner"), F.ceil(F.sqrt("chunks")).cast("int")))
    merged = merged.repartition("n_bytes", "hash", "salt").select(*names).mapInArrow(_own(trie_bytes, True), OWNED_SQL)
    rest = rows.filter("chunks is null").select(*names).unionByName(merged)
    done = []
    for again in range(MOST_PASSES):
        dealt = rest.repartition(F.col("n_bytes") + again, "hash").select(*names)
        found = settle(dealt.mapInArrow(_own(trie_bytes), OWNED_SQL), "tries")
        done.append(found.filter("body is null").select(F.explode("owners").alias("owner"), "hash", F.col("low").alias("first"), F.col("high").alias("last"), F.col("rows").alias("size")))
        rest = found.filter("body is not null")
        if not rest.limit(1).count():
            return reduce(DataFrame.unionByName, done)
    raise RuntimeError(f"texts did not fit into tries of {trie_bytes} bytes in {MOST_PASSES} passes")


#: A text of fewer chunks is never merged in two steps; passes over what tries have given out.
SOME_CHUNKS, MOST_PASSES = 64, 200


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "last", null_ids: bool = True, chunk_bytes: int = CHUNK_BYTES, list_rows: int = LIST_ROWS, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row for each row of `docs`: id, keep_id, group_size, kept, text_sha256 (of the text with A-Z lower-cased).

    Equal means the same bytes after lower-casing A-Z; a null text is the empty one. Of each group the row with the
    largest identifier stays (`keep="first"`: the smallest). Rows with a null identifier are members that count and are
    never the one that stays: their kept is null, and so is the keep_id of a group that has no others; without `null_ids`
    they are left out. Repeated rows with one identifier count each and are all marked kept when theirs is. An empty table
    gives an empty result; other columns of `docs` are ignored, whatever their names. `chunk_bytes`,
    `trie_bytes` and `list_rows` bound what a task holds and what a row lists; they don't change results.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows if null_ids else rows.filter("id is not null")
    members = settle(rows.mapInArrow(_collapse(chunk_bytes, list_rows), "owner long, part long, ids array<long>, low long, high long, rows long, n_bytes long, hash long, sha string, body binary"), "texts")
    # A chunk lists a text once and an identifier's text has one hash, so (owner, hash) names the row of a chunk;
    # where one row is repeated over chunks its owner rows agree, and are merged.
    owners = _owned(members.filter("body is not null").select("owner", "hash", "low", "high", "rows", "n_bytes", "body"), trie_bytes)
    owners = owners.groupBy("owner", "hash").agg(F.max("first").alias("first"), F.max("last").alias("last"), F.max("size").alias("size"))
    stays = F.when(F.col("first") <= F.col("last"), F.col("last") if keep == "last" else F.col("first"))
    return (
        members.select("owner", "hash", "sha", "ids")
        .join(owners, ["owner", "hash"])
        .select(F.explode("ids").alias(id_col), stays.alias("keep_id"), F.col("size").alias("group_size"), F.col("sha").alias("text_sha256"))
        .select(id_col, "keep_id", "group_size", (F.col(id_col) == F.col("keep_id")).alias("kept"), "text_sha256")
    )
