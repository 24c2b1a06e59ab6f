import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.llm.packing import OpenWindows, best_fit, pack
from quillspark.llm.piece_codec import CharacterMap, encode_pieces, piece_codec
from quillspark.llm.queries import op8_sentencepiece, tokenizer_path
from quillspark.llm.word_tokens import word_tokens

WORDS, PIECES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "\n", "a\n", " a", "a ", "▁", "a▁ b", "▁\nb", "x  \n y", "don't we'LL", "<|endoftext|> x", "İΣς ß ﬁ é", "\x1c\x85 a", "漢字 😀"]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab E\n ▁é'sΣß\t\r\x1c\x85\u0301ﬁ漢😀|<>09_$.,", max_size=40))
def test_codecs_match_the_libraries(text):
    codec, words = piece_codec(PIECES), word_tokens(WORDS)
    [(ids, begins, ends)] = codec.encode([text])
    assert ids.tolist() == codec.library.encode(text)
    raw = text.encode()
    assert b"".join(raw[b:e] for b, e in zip(begins, ends, strict=True)) == raw
    assert np.frombuffer(words.encode(text), "<u4").tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


def double_array(entries):
    """A trie by brute force: units of one node for each byte, placed where its children don't collide."""
    units = {0: [0, 0, False]}
    tree = {}
    for key, value in entries.items():
        node = tree
        for b in key:
            node = node.setdefault(b, {})
        node[None] = value

    def put(node, at):
        base = next(o for o in range(1, 4096) if all((at ^ o) ^ (0 if b is None else b) not in units for b in node))
        units[at][0] = base
        for b in node:
            units[(at ^ base) ^ (0 if b is None else b)] = [0, b, False]
        for b, child in node.items():
            where = (at ^ base) ^ (0 if b is None else b)
            if b is None:
                units[at][2] = True
                units[where] = [None, child, False]
            else:
                put(child, where)

    put(tree, 0)
    out = np.zeros(max(units) + 1, "<u4")
    for at, (base, label, leaf) in units.items():
        out[at] = (label | 1 << 31) if base is None else (base << 10 | label | (1 << 8 if leaf else 0))
    return out


def test_character_map_takes_the_longest_prefix_and_keeps_alignment():
    replaced = b"fi\0A\0xyz\0"
    blob = double_array({"ﬁ".encode(): 0, b"ab": 3, b"abc": 5}).tobytes()
    table = CharacterMap(len(blob).to_bytes(4, "little") + blob + replaced)
    assert table.longest(b"abcd", 0) == (3, b"xyz") and table.longest(b"abd", 0) == (2, b"A") and table.longest(b"b", 0) is None
    codec = object.__new__(type(piece_codec(PIECES)))
    codec.map, codec.dummy_prefix, codec.squeeze, codec.escape, codec.mark = table, True, True, True, "▁".encode()
    norm, origin = codec.normalize("  ﬁ  abc ")
    assert norm == "▁fi▁xyz"
    assert origin.tolist() == [2, 2, 2, 2, 2, 5, 5, 5, 7, 7, 7, 10]


def test_encode_rows(spark):
    rows = [(i, t) for i, t in enumerate([*ODD, None])] + [(0, ""), (None, "null id")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in encode_pieces(df, PIECES).collect()), key=str)
    lib = piece_codec(PIECES).library
    assert got == sorted(((i, lib.encode(t or ""), lib.decode(lib.encode(t or ""))) for i, t in rows), key=str)
    assert encode_pieces(df.limit(0), PIECES).count() == 0


def spans(lib, ids):
    """Where pieces stand in a text without marks of its own: one space is put before it, and a byte piece is one byte."""
    sizes = [1 if lib.is_byte(i) else len(lib.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
    ends = np.cumsum(sizes).tolist()
    return [max(0, e - n - 1) for e, n in zip(ends, sizes, strict=True)], [e - 1 for e in ends]


def test_long_chunks_are_not_kept():
    codec = type(piece_codec(PIECES))(PIECES)
    [(ids, _, _)] = codec.encode(["x" * 5000 + " short"])
    assert ids.tolist() == codec.library.encode("x" * 5000 + " short")
    assert list(codec.cache) == ["short"] and 0 < codec.cached < 1000


def test_op8_against_the_library(spark, sf_dir):
    lib = piece_codec(PIECES).library
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in op8_sentencepiece(spark, sf_dir).collect():
        ids = lib.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids)))
    listed = [(i, *spans(lib, lib.encode(t))) for i, t in texts.items()]
    want = spark.createDataFrame(listed, "doc_id long, begins array<int>, ends array<int>").select("doc_id", F.xxhash64("begins", "ends").alias("h"))
    assert {r.doc_id: r.h for r in want.collect()} == {r.doc_id: r.spans_xxhash64 for r in op8_sentencepiece(spark, sf_dir).collect()}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_takes_the_tightest_window(lengths):
    lengths = sorted(lengths, reverse=True)
    where, offsets = best_fit(lengths, 64)
    rooms: list[int] = []
    for n, k, at in zip(lengths, where, offsets, strict=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            assert rooms[k] == min(fits) and at == 64 - rooms[k]
        else:
            assert k == len(rooms) and at == 0
            rooms.append(64)
        rooms[k] -= n
    assert OpenWindows(64).take(1) is None


def check_packing(spark, df, rows, **options):
    out = pack(df, WORDS, **options).collect()
    enc = word_tokens(WORDS).tokenizer
    by_doc: dict = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, text in rows:
        ids = [*enc.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        assert sum(p.length for p in pieces) == len(ids) and [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        for p in pieces:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    seqs: dict = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:], strict=False)) and sum(s[-1]) <= 4096
    return out


def test_packing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = check_packing(spark, docs, rows)
    used = sum(r.length for r in out)
    assert used > 0.97 * 4096 * len({r.sequence_id for r in out}) - 4096


def test_packing_odd_rows(spark):
    rng = random.Random(5)
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "a b c"), *((i, "tok " * rng.randrange(900)) for i in range(10, 60))]
    df = spark.createDataFrame([(i, t, 0, "x", 3) for i, t in rows], "doc_id long, text string, length int, offset string, _group long")
    check_packing(spark, df, rows, group_pieces=10)
    assert pack(df.limit(0), WORDS).count() == 0
    twice = pack(spark.createDataFrame([(7, "same"), (7, "same"), (None, "x")], "doc_id long, text string"), WORDS, with_ids=True).collect()
    assert len(twice) == 3 and all(len(r.ids) == r.length for r in twice)


def test_vocabulary_path_is_a_parameter():
    with pytest.raises(FileNotFoundError):
        word_tokens("/nowhere.json")
