"""SentencePiece encoding that keeps offsets, and decoding.

Normalisation walks the text by longest prefixes through the model's compiled character map (a double-array trie) and
records for every normalised byte the source byte it came from. Pieces are found in the normalised text, and each is
projected through that record to a span of original bytes. The merge rules of the model run in the library, over a copy
of the model without normalisation, one chunk at a time: no piece has a non-space before a space mark, so merges never
cross from one chunk to the next and a worker can keep the pieces of chunks it has met.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: The chunks that a worker remembers hold so many bytes at most, and each of them so many characters.
CACHED_BYTES, CACHED_CHARS = 64_000_000, 256
#: Texts are encoded together until they have so many characters, which bounds what a worker holds.
TOGETHER = 400_000


def _fields(raw: bytes) -> Iterator[tuple[int, int, object]]:
    """(field number, wire type, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = raw[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            value: object = varint()
        elif kind == 2:
            n = varint()
            value, at = raw[at : at + n], at + n
        else:
            n = 8 if kind == 1 else 4
            value, at = raw[at : at + n], at + n
        yield tag >> 3, kind, value


def _message(number: int, body: bytes) -> bytes:
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    return varint(number << 3 | 2) + varint(len(body)) + body


class CharacterMap:
    """A compiled character map: the size of a double-array trie, the trie, then replacements that end with a zero."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size :] if blob else b""

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement) of the longest prefix of text[at:] that the map has."""
        units, found = self.units, None
        if not units:
            return None
        node = 0
        node ^= self._offset(units[node])
        for k in range(at, len(text)):
            node ^= text[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = (k + 1 - at, self.replacements[start : self.replacements.index(0, start)])
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)


class PieceCodec:
    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            raw = f.read()
        spec, plain, pieces, kinds = b"", b"", [], []
        for number, kind, value in _fields(raw):
            if number == 3:
                spec = value
            if number == 1:
                one = {n: v for n, _, v in _fields(value)}
                pieces.append(one[1])
                kinds.append(one.get(3, 1))
            if number in (1, 2) and kind == 2:
                plain += _message(number, value)
        options = {n: v for n, _, v in _fields(spec)}
        self.map = CharacterMap(options.get(2, b""))
        self.dummy_prefix, self.squeeze, self.escape = (bool(options.get(k, 1)) for k in (3, 4, 5))
        # Without normalisation: no dummy prefix, no squeezing, spaces escaped (there are none left).
        self.plain = sentencepiece.SentencePieceProcessor(model_proto=plain + _message(3, _message(1, b"identity") + b"\x18\x00\x20\x00\x28\x01"))
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        # A byte piece, shown as <0x0A>, covers one byte; any other piece its own bytes.
        self.sizes = np.array([1 if k == 6 else len(p) for p, k in zip(pieces, kinds, strict=True)], "u4")
        if 6 not in kinds or 4 in kinds or self.sizes.max() > 255:
            raise ValueError("needs a model with byte fallback and without pieces defined by users")
        mark = MARK.encode()
        normal = [p.decode() for p, k in zip(pieces, kinds, strict=True) if k == 1]
        self.chunked = self.escape and not any(MARK in p.lstrip(MARK) for p in normal)
        self.lines_apart = not any("\n" in p for p in normal)
        self.mark = mark
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """(normalised text, for each of its bytes and its end the source byte it came from)."""
        source = text.encode()
        mark = self.mark if self.escape else b" "
        if not self.map.units and not self.squeeze:
            if not source:
                return "", np.zeros(1, "i4")
            raw = np.frombuffer(source, "u1")
            from_byte = np.repeat(np.arange(len(raw), dtype="i4"), np.where(raw == 32, len(mark), 1))
            prefix = np.zeros(len(mark) * self.dummy_prefix, "i4")
            return (mark.decode() if self.dummy_prefix else "") + text.replace(" ", mark.decode()), np.concatenate([prefix, from_byte, [len(raw)]]).astype("i4")
        units: list[tuple[bytes, int]] = []
        at = 0
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit:
                size, body = hit
            else:
                lead = source[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                body = source[at : at + size]
            units.append((body, at))
            at += size
        ends = len(source)
        if self.squeeze:
            while units and not units[0][0].strip(b" "):
                units.pop(0)
        out, origin, space = bytearray(), [], self.squeeze
        if units and self.dummy_prefix:
            out += mark
            origin += [units[0][1]] * len(mark)
            space = True
        for body, at in units:
            if self.squeeze and space:
                body = body.lstrip(b" ")
            if not body:
                continue
            space = body.endswith(b" ")
            made = body.replace(b" ", mark)
            out += made
            origin += [at] * len(made)
        if self.squeeze:
            while out.endswith(mark):
                del out[-len(mark) :]
                ends = origin[-len(mark)]
                del origin[-len(mark) :]
        return out.decode(), np.array([*origin, ends], "i4")

    def _keys(self, text: str) -> list[str]:
        """The chunks of a normalised text. One that begins with a mark is named without it, one that begins with a line end with it."""
        body = text[1:] if text.startswith(MARK) else None
        if body is None or not self.chunked:
            return []
        if MARK * 2 in text or body.startswith(MARK) or body.endswith(MARK):
            keys, at = [], 0
            while at < len(text):
                end = at
                while end < len(text) and text[end] == MARK:
                    end += 1
                end = text.find(MARK, end)
                end = len(text) if end < 0 else end
                if self.lines_apart and text.startswith("\n", at + 1):
                    keys.append("")
                keys.append(text[at + 1 : end])
                at = end
            return keys
        if self.lines_apart and "\n" in body:
            body = body.replace("\n", MARK + "\n")
            # A line end is a byte piece of its own, so a chunk may begin with it; such a key stands for itself.
        return body.split(MARK)

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text (ids, begins, ends), the last two in bytes of the original text."""
        normed = [self.normalize(t) for t in texts]
        keyed = [self._keys(n) if n else [] for n, _ in normed]
        if self.cached > CACHED_BYTES:
            self.cache.clear()
            self.cached = 0
        cache = self.cache
        missing = [k for k in {k for keys in keyed for k in keys} if k not in cache]
        long = [k for k in missing if len(k) > CACHED_CHARS]
        if missing:
            for k, ids in zip(missing, self.plain.encode([k if k.startswith("\n") and self.lines_apart else MARK + k for k in missing], num_threads=1), strict=True):
                cache[k] = self._packed(ids)
                # What Python holds for a key and its entry, besides their bytes.
                self.cached += 200 + len(k) + len(cache[k])
        out = []
        for (text, origin), keys in zip(normed, keyed, strict=True):
            packed = b"".join([cache[k] for k in keys]) if keys else self._packed(self.plain.encode(text)) if text else b""
            both = np.frombuffer(packed, "<u4")
            ends = np.cumsum(both & 255)
            out.append(((both >> 8).astype("i4"), origin[ends - (both & 255)], origin[ends]))
        for k in long:
            self.cached -= 200 + len(k) + len(cache.pop(k))
        return out

    def _packed(self, ids: list[int]) -> bytes:
        """Each id with the bytes that its piece covers."""
        return (np.array(ids, "u4") << np.uint32(8) | self.sizes[ids]).astype("<u4").tobytes() if ids else b""

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


@lru_cache(maxsize=2)
def piece_codec(path: str) -> PieceCodec:
    """One for each worker process and file."""
    return PieceCodec(path)


def encode_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """id, ids array<int>, begins array<int>, ends array<int>, decoded string for each row of `docs`.

    Spans are in bytes of the original text; the dummy prefix covers none. A null or empty text has no ids and decodes
    to the empty text; a null id stays null; repeated rows stay; an empty table stays empty; other columns are ignored.
    """
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("decoded", pa.string())])

    def ragged(parts: list[np.ndarray]) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("i4")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype("i4")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(path)

        def given(ids: list, texts: list[str]) -> pa.RecordBatch:
            found = codec.encode(texts)
            back = codec.decode([x[0].tolist() for x in found]) if decode else [None] * len(found)
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(ragged([x[k] for x in found]) for k in range(3)), pa.array(back, pa.string())], schema=schema)

        for batch in batches:
            ids, texts, size = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size > TOGETHER:
                    yield given(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield given(ids, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>, begins array<int>, ends array<int>, decoded string").withColumnRenamed("id", id_col)
