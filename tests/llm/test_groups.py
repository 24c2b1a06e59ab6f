import collections
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from quillspark.llm import line_dedup
from quillspark.llm.chat_format import format_chats
from quillspark.llm.common import connected_components, lookup
from quillspark.llm.line_dedup import drop_boilerplate
from quillspark.llm.sharding import place, shard_groups


def test_shards(spark):
    rng = random.Random(2)
    texts = ["w " * rng.randrange(1, 200) for _ in range(900)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2000 + i, "the same hot text " * 5) for i in range(600)] + [(5000, None), (5001, ""), (None, "x"), (0, texts[0])]
    df = spark.createDataFrame([(i, t, "y", 3) for i, t in rows], "doc_id long, text string, shard string, size int")
    out = shard_groups(df).collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in out) == sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows)
    sizes, slots, where = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in out:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        where[r.text_crc32].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(sizes) == 16
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 16
    hot = zlib.crc32(("the same hot text " * 5).encode())
    assert all(len(s) == 1 for k, s in where.items() if k != hot)
    assert shard_groups(df.limit(0)).count() == 0


def test_a_group_that_fits_a_shard_stays_whole(spark):
    """50 of 1,000 equal rows are less than a sixteenth; 100 are more and are cut."""
    rows = [(i, f"text {i} " + "w " * 40) for i in range(1000)] + [(2000 + i, "same text " + "w " * 40) for i in range(50)]
    got = shard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.shard for r in got if r.doc_id >= 2000}) == 1
    sizes = collections.Counter()
    for r in got:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values()) / 16
    rows += [(3000 + i, "same text " + "w " * 40) for i in range(100)]
    got = shard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r.shard for r in got if r.doc_id >= 2000}) > 1


def test_shards_against_a_plain_recount(spark):
    """Items, their placement and their slots, worked out again row by row."""
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(1, 60) + str(i % 400)) for i in range(700)] + [(1000 + i, "hot text") for i in range(150)] + [(2000 + i, "warm " * 30) for i in range(12)] + [(None, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    text = F.coalesce("text", F.lit(""))
    known = df.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h"), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 62)).alias("i"), F.xxhash64("doc_id").alias("x"), F.xxhash64("doc_id", F.lit("part")).alias("p")).collect()
    weight = lambda r: np.array([len(r.text.encode()) + 1, r.text.count(" ") + 1, 1], float)
    total = sum(weight(r) for r in known)
    groups = collections.defaultdict(list)
    for r in known:
        groups[r.h].append(r)
    share = {h: (sum(weight(r) for r in g) / total).max() for h, g in groups.items()}
    heavy = sorted(h for h, s in share.items() if s > 1 / 1024)
    items = collections.defaultdict(list)
    for h, g in groups.items():
        for r in g:
            cut = int(np.ceil(share[h] * 256)) if share[h] * 16 > 1 else 1
            items[8192 + heavy.index(h) * 512 + r.x % cut if h in heavy else h % 8192].append(r)
    residual, where = np.full((16, 3), 1 / 16), {}
    order = sorted(items, key=lambda k: (-(sum(weight(r) for r in items[k]) / total).sum(), k))
    for k in order:
        need = sum(weight(r) for r in items[k]) / total
        fits = [s for s in range(16) if residual[s][0] >= need[0]]
        best = max(fits, key=lambda s: ((residual[s] * need).sum(), -s)) if fits else max(range(16), key=lambda s: (residual[s][0], -s))
        where[k] = best
        residual[best] -= need
    want, first = [], collections.Counter()
    for k in sorted(items):
        parts = -(-len(items[k]) * 2048 // len(known))
        by = collections.defaultdict(list)
        for r in items[k]:
            by[r.p % parts].append(r)
        for q in sorted(by):
            for r in sorted(by[q], key=lambda r: (r.doc_id is not None, r.doc_id or 0, zlib.crc32(r.text.encode()))):
                want.append((r.doc_id, where[k], first[where[k]]))
                first[where[k]] += 1
    got = [(r.doc_id, r.shard, r.slot) for r in shard_groups(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_shards_of_a_very_long_text(spark):
    rows = [(1, "long " * 400_000), (2, "a"), (3, None), (4, "a")]
    got = {r.doc_id: r for r in shard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].size == 2_000_001 and len(got) == 4 and len({got[2].shard, got[4].shard} - {got[1].shard}) >= 1


def test_place_balances_all_three():
    rng = np.random.default_rng(1)
    w = rng.integers(1, 100, (4000, 3)).astype(float)
    got = place(w, 16)
    for k, most in ((0, 0.002), (1, 0.05), (2, 0.05)):
        sums = np.bincount(got, w[:, k], minlength=16)
        assert (sums.max() - sums.min()) / sums.mean() < most


def boilerplate(rows, least):
    sites = collections.defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if line and site is not None:
                sites[line].add(site)
    gone = {k for k, s in sites.items() if len(s) >= least}
    out = []
    for i, text, site in rows:
        if text is None:
            out.append((i, None, site, 0, 0, False))
            continue
        lines = text.split("\n")
        rest = [x for x in lines if x not in gone]
        only = len(rest) < len(lines) and not any(rest)
        rest = lines if only else rest
        out.append((i, "\n".join(rest), site, len(lines), len(lines) - len(rest), only))
    return sorted(out, key=str)


def test_lines(spark):
    rng = random.Random(4)
    menu, edge = "home | about | contact", "on nine sites only"
    rows = []
    for i in range(300):
        site = f"s{i % 14}"
        text = f"own text of page {i} that is long enough to stay\nand more {rng.random()}\n"
        if i % 3 == 0:
            text = f"{menu}\n{text}\n\n{menu}"
        if i % 14 < 9:
            text += "\n" + edge
        rows.append((i, text, site))
    rows += [(900, menu, "s1"), (901, "", "s1"), (902, None, "s1"), (903, f"{menu}\n" * 3 + "x", None), (904, "own longer line of text here\n" + menu, None), (0, *rows[0][1:])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, n_lines int")
    got = sorted(((r.doc_id, r.text, r.source, r.n_lines, r.n_removed, r.only_shared) for r in drop_boilerplate(df).collect()), key=str)
    assert got == boilerplate(rows, 10)
    assert sum(r[4] for r in got) > 100 and sum(r[5] for r in got) == 1
    assert drop_boilerplate(df.limit(0)).count() == 0


def test_lines_leave_a_page_that_is_mostly_boilerplate(spark):
    rows = [(i, "a long notice that all sites show below their pages\n" * 9 + f"own {i}", f"s{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id: (r.text, r.n_removed) for r in drop_boilerplate(df).collect()} == {i: (f"own {i}", 9) for i in range(12)}


def test_lines_columns_of_any_name_pass_through(spark):
    names = ["_text", "_id", "_gone", "mark", "pos", "at", "line", "site", "rest", "parts", "text_mark", "id", "salt", "sites"]
    rows = [(i, f"menu\nown {i}", f"s{i}", *names) for i in range(12)]
    got = drop_boilerplate(spark.createDataFrame(rows, ["doc_id", "text", "source", *names])).collect()
    assert len(got) == 12 and all(r.text == f"own {r.doc_id}" and all(r[n] == n for n in names) for r in got)


def test_lines_of_a_very_long_text(spark):
    rows = [(i, "\n".join(f"l{k}" for k in range(60_000)) + f"\nown {i}", f"s{i}") for i in range(10)]
    got = drop_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((r.text, r.n_removed) for r in got) == sorted((f"own {i}", 60_000) for i in range(10))


def test_near_threshold_lines_are_counted_exactly(spark):
    lines = [(k, s, 10_000 * k + s) for k in range(900, 1100, 20) for s in range(k)]
    df = spark.createDataFrame(lines, "line long, site long, at long")
    got = sorted(r.line for r in line_dedup.line_spread(df, 1000).collect())
    assert got == [k for k in range(900, 1100, 20) if k >= 1000]


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(1000, 1040)]
    name = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            name[a] = name[b] = min(name[a], name[b])
    df = spark.createDataFrame(edges, "a long, b long").repartition(7)
    for task_links in (20_000, 30):
        got = {r.node: r.component for r in connected_components(df, task_links=task_links).collect()}
        assert got == {k: v for k, v in name.items() if k in got} and set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_lookup_salts_hot_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(500)] + [(2, 1000), (None, 1001)], "k long, i long")
    right = spark.createDataFrame([(1, "a", 500), (3, "c", 1)], "k long, v string, n long")
    got = lookup(left, right, "k", "n", 502, F.col("i")).select("k", "i", "v").collect()
    assert len(got) == 502 and all(r.v == ("a" if r.k == 1 else None) for r in got)


def test_chats(spark):
    def conv(i, *texts, first=0, step=1):
        return [(i, first + step * k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(texts)]

    long_one = [f"turn {k}" for k in range(600)]
    rows = [
        *conv(1, "a", "b"), *conv(2, "a", "b", "c"), *conv(3, "a"), *conv(4, "a", "b", "d"), *conv(5, "a", "b", "c", first=10, step=3), *conv(6, "x <|user|> y"), *conv(7, "", "b"),
        *conv(8, *long_one), *conv(9, *long_one[:300]), (10, None, None, None), (11, 0, " USER ", "a"), (None, 0, "user", "lost"), *conv(2, "a"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, chat string")
    got = collections.defaultdict(list)
    for r in format_chats(df).collect():
        got[r.conv_id].append(r)
    # 1, 3, 9 and 11 are prefixes; 5 repeats 2 with other turn numbers.
    assert sorted(got) == [2, 4, 6, 7, 8, 10]
    assert "".join(r.chat for r in got[2]) == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n"
    assert got[6][0].chat == "<|user|>\nx < |user|> y<|end|>\n" and got[10][0].chat == "<|unknown|>\n<|end|>\n"
    assert len(got[8]) == 1 and got[8][0].n_turns == 600 and got[8][0].chat == "".join(f"<|{'user' if k % 2 == 0 else 'assistant'}|>\n{t}<|end|>\n" for k, t in enumerate(long_one))
    assert format_chats(df.limit(0)).count() == 0


def test_chats_with_equal_or_null_turns(spark):
    rows = [(1, 0, "user", f"t{k:04}") for k in range(600)] + [(2, None, "user", f"t{k:04}") for k in range(300)] + [(3, None, None, None), (3, None, None, None)]
    got = {r.conv_id: r for r in format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    # The turns of 2 are the first of 1.
    assert sorted(got) == [1, 3] and got[1].chat.count("<|end|>") == 600 and got[3].chat == "<|unknown|>\n<|end|>\n"


def test_rows_of_one_text_and_no_id_are_cut(spark):
    """800 of 1,000 rows share a text, and have no id or one and the same: sizes are near equal all the same."""
    for hot in (None, 5):
        rows = [(hot, "same text here")] * 800 + [(1000 + i, f"text {i}") for i in range(200)]
        got = shard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        sizes, slots = collections.Counter(), collections.defaultdict(list)
        for r in got:
            sizes[r.shard] += r.size
            slots[r.shard].append(r.slot)
        assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) < 0.05 * sum(sizes.values()) / 16
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
