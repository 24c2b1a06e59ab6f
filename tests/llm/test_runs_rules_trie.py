"""Periodic runs, adaptive quality rules and the prefix trie, each against a brute-force version."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import queries as Q
from quillspark.llm.chat_format import format_chats
from quillspark.llm.common import table
from quillspark.llm.periodic_runs import all_runs, may_hold_runs, periodic_runs, text_runs
from quillspark.llm.prefix_trie import prefix_trie, rebuilt
from quillspark.llm.quality_rules import FENCE, LEAST_DOCS, MEASURES, apply_rules, bucket, least_of

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    return (text or "").encode().split()


def runs_by_hand(words, least=6, periods=4):
    """Every stretch in which words q apart agree, by its smallest q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at < len(words) - q:
            end = at
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            if end - at >= q and (at, end + q) not in found:
                found[at, end + q] = q
            at = max(end, at + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items() if b - a >= max(least, periods * q))


def random_words(rng, letters, n):
    out = []
    while len(out) < n:
        unit = [rng.randrange(letters) for _ in range(rng.randint(1, 7))]
        out += (unit * rng.randint(1, 6))[: rng.randint(1, 40)]
    return out[:n]


def test_all_runs_of_random_sequences():
    rng = random.Random(1)
    for _ in range(1500):
        words = random_words(rng, rng.choice([1, 2, 3, 5, 20]), rng.randint(1, 70))
        symbols = np.unique(np.array(words), return_inverse=True)[1].astype("i8")
        assert [tuple(map(int, x)) for x in zip(*all_runs(symbols), strict=True)] == runs_by_hand(words, 2, 2)


def test_runs_of_many_texts_at_once():
    """Texts are told apart, and the ones that are passed over hold no run."""
    rng = random.Random(2)
    texts = [random_words(rng, rng.choice([1, 2, 4, 9, 50]), rng.randint(0, 60)) for _ in range(400)] + [[7] * 50, [7] * 50, []]
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    numbers = np.array([w for t in texts for w in t], "i8")
    got = text_runs(numbers, first)
    assert {k: [tuple(r) for r in v] for k, v in got.items()} == {k: r for k, t in enumerate(texts) if (r := runs_by_hand(t))}
    assert set(got) <= set(may_hold_runs(numbers, first).tolist())


@pytest.mark.parametrize("symbols", [np.zeros(50_000, "i8"), np.tile(np.random.default_rng(0).integers(0, 90, 9000), 6), np.arange(50_000)])
def test_long_sequences_stay_linear(symbols):
    found = [tuple(map(int, x)) for x in zip(*all_runs(symbols), strict=True) if x[1] >= 4 * x[2]]
    if symbols.any():
        assert found == ([(0, 54_000, 9000)] if len(symbols) == 54_000 else [])
    else:
        assert found == [(0, 50_000, 1)]


def test_runs_in_odd_tables(spark):
    rows = [(1, "a b " * 4), (1, "a b " * 4), (None, "x " * 6), (3, None), (4, ""), (5, " \t\n"), (6, "x x x x x x x x x x x x"), (7, "head " + "p q r\n" * 30 + "tail"), (8, "w " * 200_000)]
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, runs int, id string")
    got = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect())
    want = [("1", [(0, 8, 2)], "a b"), ("1", [(0, 8, 2)], "a b"), ("3", [], ""), ("4", [], ""), ("5", [], ""), ("6", [(0, 6, 1)], "x x"), ("7", [(1, 90, 3)], "head p q r tail"), ("8", [(0, 200_000, 1)], "w"), ("None", [(0, 6, 1)], "x")]
    assert got == want and periodic_runs(df.limit(0)).count() == 0


def test_query_of_runs_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in Q.op11_periodic_runs(spark, sf_dir).collect()}
    assert set(got) == set(docs)
    seen = 0
    for i, text in docs.items():
        words = words_of(text)
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = runs_by_hand(words) if n < 1200 or h % 10 == 0 else None
        if runs is None:
            continue
        seen += len(runs)
        r = got[i]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, 1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()
    assert seen > 10


def measured(text):
    words = [w.decode() for w in words_of(text)]
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(repeated)


def rules_by_hand(rows, least_docs):
    """Thresholds from whole sorted lists of values, rounded as a sketch's buckets are."""
    def cut(v):
        shift = max(0, v.bit_length() - 7)
        return v >> shift << shift

    counted = [(i, lang, source, *measured(text)) for i, text, lang, source in rows]
    failed = lambda r: r[3] < 50 or 100 * r[8] > 50 * r[3]
    value = lambda r: (100 * r[4] // r[3], 1000 * r[5] // r[3], 1000 * r[7] // r[6], 1000 * r[8] // r[3])
    groups = collections.defaultdict(list)
    for r in counted:
        if not failed(r):
            for key in ((r[1], r[2]), (r[1],), ()):
                groups[key].append(value(r))

    def bounds(values):
        out = []
        for k, (_, _, least, both) in enumerate(MEASURES):
            v = sorted(cut(x[k]) for x in values)
            q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
            wide = FENCE * max(q3 - q1, least)
            out.append((q1 - wide if both else -1, q3 + wide))
        return out

    result = []
    for r in counted:
        kept = not failed(r)
        if kept:
            key = next(k for k in ((r[1], r[2]), (r[1],), ()) if len(groups[k]) >= least_docs or not k)
            kept = all(low <= v <= high for v, (low, high) in zip(value(r), bounds(groups[key]), strict=True))
        result.append((r[0], *r[3:], failed(r), kept))
    return sorted(result, key=str)


def test_rules_against_whole_lists(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    rows = []
    for k in range(420):
        size = {0: 5, 1: 5, 2: 9}[k % 3]
        text = " ".join(word(max(1, int(rng.gauss(size, 1)))) for _ in range(rng.randrange(30, 160)))
        text = {5: text.replace(" ", " # ", 30), 7: "\n".join([text[:90]] * 6 + [text]), 9: text + " one two three" * 20, 11: text.replace(" ", "\n"), 13: word(3000) + " " + text}.get(k % 40, text)
        rows.append((k, text, ["en", "de", None][k % 3], ["a", "b", None, "c"][k % 4] if k % 50 else "rare"))
    rows += [(9001, None, "en", "a"), (9002, "", None, None), (9003, "word", "xx", "y"), (9004, "é😀 " * 60, "zz", "z"), (5, rows[5][1], "en", "a"), (5, rows[5][1], "en", "a")]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, lang string, source string, key string, n_words int")
    for least in (20, LEAST_DOCS):
        got = apply_rules(df, least_docs=least).collect()
        assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in got), key=str) == rules_by_hand(rows, least)
        assert {r.reason == "" for r in got if r.kept} == {True} and all(r.reason == "base" for r in got if r.base_failed)
    assert apply_rules(df.limit(0)).count() == 0


def test_buckets(spark):
    values = [*range(300), 1023, 1024, 65_535, 10**6, 2**40 + 12345]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", least_of(bucket(F.col("v"))).alias("low"), bucket(F.col("v")).alias("b")).collect()
    assert all(r.low <= r.v and (r.v - r.low) * 64 <= r.v for r in got) and all(r.low == r.v for r in got if r.v < 128)
    assert [r.b for r in got] == sorted(r.b for r in got)


def test_rules_keep_clean_documents(spark):
    """Of the documents that are marked as good and long enough to be judged, nearly all stay; of the others many go."""
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    judged = Q.op12_quality_rules(spark, sf).filter("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in judged}
    assert share[1] > 0.995 and share[0] < 0.75


def trie_by_hand(convs):
    """Nodes of {conv_id: [(role, text)]}, by walking every prefix."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) if children[p] else 1
        saved[p] = sum(saved[x] for x in children[p]) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(str(c) for c in sorted(c for c in members[p] if len(convs[c]) == len(p))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), leaves[p], saved[p], digest(p)) for p, m in members.items())


def nodes(df):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def as_tables(spark, convs):
    rows = [(c, k, role, text, "x") for c, turns in convs.items() for k, (role, text) in enumerate(turns, 1)]
    return spark.createDataFrame(rows, "conv_id long, pos long, role string, text string, owner string"), spark.createDataFrame([(c, len(t)) for c, t in convs.items()], "conv_id long, turns long")


def test_trie_of_random_conversations(spark):
    rng = random.Random(3)
    convs = {}
    for c in rng.sample(range(-50, 400), 160):
        base = list(convs[rng.choice(list(convs))]) if convs and rng.random() < 0.7 else []
        convs[c] = base[: rng.randint(0, len(base))] + [(rng.choice("ua"), rng.choice(["", "x", "é😀", "long text"])) for _ in range(rng.randint(0, 4))]
    assert nodes(prefix_trie(*as_tables(spark, convs))) == trie_by_hand(convs)


def test_snapshots_copies_and_a_long_conversation(spark):
    """Every prefix of one conversation as one of its own, with rising and falling ids; copies; one of 3,000 turns."""
    turns = [("u" if k % 2 else "a", f"turn {k}") for k in range(70)]
    convs = {k: turns[:k] for k in range(71)} | {1000 - k: turns[:k] + [("u", "other")] for k in range(40)} | {2000 + k: turns[:5] for k in range(300)} | {5000: [("u", f"t{k}") for k in range(3000)]}
    assert nodes(prefix_trie(*as_tables(spark, convs))) == trie_by_hand(convs)


def test_trie_of_odd_tables(spark):
    turns, convs = as_tables(spark, {7: [], 9: []})
    assert nodes(prefix_trie(turns.limit(0), convs)) == trie_by_hand({7: [], 9: []})
    assert prefix_trie(turns.limit(0), convs.limit(0)).count() == 0


def test_rebuilt_conversations(spark):
    rows = [(c, t, r, x) for c in (0, 1, 2, 3, 4, 6, 8, 10, 11) for t, r, x in [(1000 + k, "u", f"{c // 5} {k}") for k in range(c % 4 + 5)] + [(None, None, None)]] + [(6, 1001, "u", "1 1"), (None, 1, "u", "lost"), (12, 5, "b", "x"), (12, 5, "a", "y")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, pos int")
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    head = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    want = {c: own.get(c - c % 5, [])[: head[c]] + v[head[c] :] for c, v in own.items()}
    turns, convs = rebuilt(df)
    got = {r.conv_id: [] for r in convs.collect()}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.pos)):
        got[r.conv_id].append((r.role, r.text))
        assert r.pos == len(got[r.conv_id])
    assert got == want and {r.conv_id: r.turns for r in convs.collect()} == {c: len(v) for c, v in want.items()}
    assert nodes(prefix_trie(turns, convs)) == trie_by_hand(want)


def test_a_conversation_is_one_row_whatever_its_turn_numbers(spark):
    """Turn numbers from 250 on, epoch seconds, negative ones, and 600 turns."""
    rows = [(1, 250 + k, "user", f"a{k}") for k in range(12)] + [(2, 1_700_000_000 + 37 * k, "user", f"b{k}") for k in range(5)] + [(3, -k, "user", f"c{k}") for k in range(4)] + [(4, k, "user", f"d{k}") for k in range(600)]
    rows += [(5, 7_000_000_000 + k, "user", f"d{k}") for k in range(450)]
    got = {r.conv_id: r for r in format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {c: r.n_turns for c, r in got.items()} == {1: 12, 2: 5, 3: 4, 4: 600}
    texts = {1: [f"a{k}" for k in range(12)], 2: [f"b{k}" for k in range(5)], 3: ["c3", "c2", "c1", "c0"], 4: [f"d{k}" for k in range(600)]}
    assert all(got[c].chat == "".join(f"<|user|>\n{t}<|end|>\n" for t in ts) for c, ts in texts.items())
