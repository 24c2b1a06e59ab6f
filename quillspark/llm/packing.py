"""Sequence packing: best-fit decreasing over a segment tree of remaining capacities.

A document becomes its ids and an end id. Overlong documents are first cut into full windows; what is left over, and
every shorter document, is placed in order of falling length into the open window with the least room that still holds
it. A segment tree over the capacities finds that window in log2(window) steps. Documents are dealt to groups by hash;
each group packs on its own, so memory is one group's and only its last windows are left unfilled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import settle
from quillspark.llm.word_tokens import word_tokens
from quillspark.llm.wordhash import trim

WINDOW = 4096
#: Pieces that one group packs, on average; with their ids, of up to 4 bytes for each place of a window, it holds far fewer.
GROUP_PIECES, GROUP_PIECES_WITH_IDS = 50_000, 2_500


class OpenWindows:
    """The open windows by remaining capacity, in a segment tree that knows which capacities have one."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.some = bytearray(2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        if not room:
            return
        self.stacks[room].append(window)
        node = room + self.leaves
        while node and not self.some[node]:
            self.some[node] = 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, window) of a tightest window with room for `need`, no longer open; None if there is none."""
        some, node = self.some, need + self.leaves
        if not some[node]:
            while node > 1 and (node & 1 or not some[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if some[2 * node] else 2 * node + 1
        room = node - self.leaves
        window = self.stacks[room].pop()
        if not self.stacks[room]:
            while node and not (node < self.leaves and (some[2 * node] or some[2 * node + 1])):
                some[node] = 0
                node >>= 1
        return room, window


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """(window number, offset) for each length; the lengths fall and none is over `window`."""
    tree, windows, where, offsets = OpenWindows(window), 0, [], []
    for n in lengths:
        found = tree.take(n) if n else None
        if found is None:
            found = (window, windows)
            windows += 1
        room, k = found
        where.append(k)
        offsets.append(window - room)
        tree.add(room - n, k)
    return where, offsets


def tokenize(docs: DataFrame, path: str, end_id: int, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, and the ids themselves if asked for."""
    names = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(names + [("ids", pa.list_(pa.int32()))] * with_ids)
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(path)
        for batch in batches:
            rows: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                n = len(ids) // 4
                for at in range(0, n, window):
                    part = ids[4 * at : 4 * (at + window)]
                    rows.append((i, at, len(part) // 4, zlib.crc32(part), n, *([np.frombuffer(part, "<i4")] if with_ids else [])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            trim()

    spark_schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, spark_schema)


def pack(docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, with_ids: bool = False, group_pieces: int | None = None) -> DataFrame:
    """The pieces of `docs` with sequence_id and offset.

    A null or empty text is its end id alone; repeated rows are packed each on its own; a null doc_id stays null; an
    empty table gives no pieces; other columns are ignored, whatever their names. Equal lengths are placed in order of
    doc_id and start. sequence_id is the group number times 2**32 plus the number of the window in its group, so ids
    are unique, stable when a task runs again, and need no pass over all windows.
    """
    pieces = settle(tokenize(docs, path, end_id, window, with_ids), "pieces")
    groups = max(1, -(-pieces.count() // (group_pieces or (GROUP_PIECES_WITH_IDS if with_ids else GROUP_PIECES))))
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    # One task packs a group: as many partitions as groups, but no more than the session would use for empty ones.
    parted = dealt.repartition(groups, "_group").sortWithinPartitions("_group", F.desc("length"), "doc_id", "start", "ids_crc32")
    base = [*pieces.columns]
    schema = ", ".join(f"{n} {t}" for n, t in pieces.dtypes) + ", sequence_id long, offset long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at = None

        def given() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).combine_chunks()
            where, offsets = best_fit(whole.column("length").to_pylist(), window)
            out = whole.select(base)
            out = out.append_column("sequence_id", pa.array(np.array(where, "i8") + (at << 32)))
            yield from out.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

        for batch in batches:
            keys = batch.column("_group").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                if at is not None and keys[a] != at:
                    yield from given()
                    held = []
                at = int(keys[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from given()

    return parted.mapInArrow(place, schema)
