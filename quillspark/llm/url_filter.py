"""URL filters: rules indexed by their rarest literal token.

A rule is a host (with its subdomains) and a path prefix, compiled to two regular expressions. Its literal tokens are
its host labels and its complete path segments. A URL that the rule fits has every one of them among its own labels and
segments, so it is enough to look the rule up under one: the one that the fewest URLs carry. The tokens of a URL fetch
candidate rules from that index, and only those expressions run. Built-in functions only.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import lookup, unused

#: Up to so many rules the index is a literal in the plan; beyond it is a table that is joined. Results are the same.
MAX_MAPPED_RULES = 512
#: Rules of one part of that table.
LISTED = 50_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null or without "://"."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_tokens(host: str, path: str) -> list[str]:
    """Host labels as `h:label`, path segments that a slash closes on both sides as `p:segment`."""
    segments = path.split("/")[1:-1] if path.startswith("/") else []
    return [f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in segments if x]


def rule_regexes(host: str, path: str) -> tuple[str, str]:
    """What the host and what the path of a URL that the rule fits look like; each is matched on its own."""
    quote = lambda s: "".join(c if c.isalnum() else "\\" + c for c in s)
    return rf"(?s)^(?:.*\.)?{quote(host)}\z", rf"(?s)^{quote(path)}"


def url_tokens(host: Column, path: Column) -> Column:
    """Every token that a rule which fits the URL may be filed under; the empty one is carried by all."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    segments = F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.concat(F.array(F.lit("")), labels, segments))


def rarest_tokens(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> list[str]:
    """For each rule the one of its literal tokens that the fewest rows of `urls` (tokens) carry, "" if it has none."""
    own = [rule_tokens(h, p) for _, h, p in rules]
    wanted = sorted({t for tokens in own for t in tokens})
    if not wanted:
        return ["" for _ in rules]
    listed = urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string")
    # One pass; what comes back is a row for each token of a rule.
    counted = urls.select(F.explode("tokens").alias("token")).join(F.broadcast(listed), "token").groupBy("token").agg(F.count("*").alias("n"))
    seen = {r.token: r.n for r in counted.collect()}
    return [min(tokens, key=lambda t: (seen.get(t, 0), t)) if tokens else "" for tokens in own]


def _mapped(tokens: Column, filed: dict[str, list[int]]) -> Column:
    """The numbers that are filed under any of `tokens`: each token is looked up in the one bucket that it hashes to."""
    size = 1 << (len(filed) - 1).bit_length()
    buckets: list[list[Column]] = [[] for _ in range(size)]
    for t, numbers in sorted(filed.items()):
        buckets[zlib.crc32(t.encode()) % size] += [F.lit(t), F.array(*[F.lit(k) for k in numbers])]
    none = F.expr("cast(map() as map<string, array<int>>)")
    index = F.array(*[F.create_map(*b) if b else none for b in buckets])
    found = F.transform(tokens, lambda t: F.try_element_at(F.get(index, F.pmod(F.crc32(t.cast("binary")), F.lit(size)).cast("int")), t))
    return F.array_distinct(F.flatten(F.array_compact(found)))


def filter_urls(df: DataFrame, rules: Sequence[tuple[str, str, str]], url: str = "url", default: str = "allow", mapped: int = MAX_MAPPED_RULES) -> DataFrame:
    """`df` with host, path, rule and verdict; the longest fitting rule wins, else `default`.

    Rules are (verdict, host, path); among equally long ones the first in the list wins. A null URL or one without "://"
    has an empty host and path, so it fits only a rule whose host and path are empty. Repeated rows stay; an empty table
    stays empty; columns of `df` named host, path, rule or verdict are replaced and all others pass through, whatever
    their names. With up to `mapped` rules the index is a literal in the plan and no row moves; with more it is a table
    that the distinct URLs are joined with by token, and the best rule of each is joined back.
    """
    host, path = url_parts(F.col(url))
    kept = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    base = df.select(*kept, host.alias("host"), path.alias("path"))
    if not rules:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    tokens = url_tokens(F.col("host"), F.col("path"))
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1] + rules[i][2]), i))
    ranked = [rules[i] for i in order]
    index: dict[str, list[int]] = {}
    for rank, token in enumerate(rarest_tokens(base.select(tokens.alias("tokens")), ranked)):
        index.setdefault(token, []).append(rank)
    if len(rules) <= mapped:
        candidates = _mapped(tokens, index)
        hosts, paths = (F.array(*[F.lit(rule_regexes(h, p)[side]) for _, h, p in ranked]) for side in (0, 1))
        # Only the expressions of candidate rules run.
        best = F.array_min(F.filter(candidates, lambda k: F.rlike("host", F.get(hosts, k)) & F.rlike("path", F.get(paths, k))))
        at = unused("best", base.columns)
        out = base.withColumn(at, best)
        name = F.get(F.array(*[F.lit(h + p) for _, h, p in ranked]), F.col(at))
        verdict = F.get(F.array(*[F.lit(v) for v, _, _ in ranked]), F.col(at))
        return out.select(*base.columns, name.alias("rule"), F.coalesce(verdict, F.lit(default)).alias("verdict"))
    spark = df.sparkSession
    filed = [(t, k, ranked[k][1] + ranked[k][2], ranked[k][0], *rule_regexes(*ranked[k][1:])) for t, numbers in index.items() for k in numbers]
    urls = base.groupBy("host", "path").agg(F.count("*").alias("times"))
    carried = urls.select("host", "path", "times", F.explode(tokens).alias("token"))
    # Each part of the table is broadcast and has LISTED rules at most, so a token that all URLs carry is no hot key.
    parts = [spark.createDataFrame(filed[k : k + LISTED], "token string, rank int, rule string, verdict string, host_regex string, path_regex string") for k in range(0, len(filed), LISTED)]
    hits = reduce(DataFrame.unionByName, [carried.join(F.broadcast(part), "token") for part in parts]).filter("rlike(host, host_regex) and rlike(path, path_regex)")
    won = hits.groupBy("host", "path").agg(F.min(F.struct("rank", "rule", "verdict")).alias("won"), F.first("times").alias("times"))
    key, times, out = (unused(n, base.columns) for n in ("url_key", "url_times", "url_won"))
    won = won.select(F.struct("host", "path").alias(key), F.col("times").alias(times), F.col("won").alias(out))
    # URLs that very many rows share, as all those without a host do, are dealt to several tasks.
    joined = lookup(base.withColumn(key, F.struct("host", "path")), won, key, times, max(1, base.count()), F.monotonically_increasing_id())
    return joined.select(*base.columns, F.col(f"{out}.rule").alias("rule"), F.coalesce(F.col(f"{out}.verdict"), F.lit(default)).alias("verdict"))
