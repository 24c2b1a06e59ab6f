import random

import pytest

from quillspark.llm.queries import URL_RULES
from quillspark.llm.url_filter import filter_urls, rule_tokens

URLS = [
    (1, "https://WWW.Example.com/en/x?q#f"), (2, "http://example.com/en/1"), (3, "http://a.example.com/en"), (4, "http://x.net/es/1"), (5, "http://net/fr/"),
    (6, None), (7, ""), (8, "no scheme.com/en/"), (9, "http://example.com"), (10, "http://com/"), (11, "http://badexample.com/en/"), (12, "http://www.example.com/en/"),
    (13, "ftp://x.NET/es/?a=b://c"), (14, "http://x.net?/es/"), (15, "http://x.net/es"), (1, "https://WWW.Example.com/en/x?q#f"), (None, "http://u.org/"),
]


def brute(url):
    if not url or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    return host, path, *judged(host, path, URL_RULES)


def judged(host, path, rules):
    fits = [(-len(h + p), k, h + p, v) for k, (v, h, p) in enumerate(rules) if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return min(fits)[2:] if fits else (None, "allow")


@pytest.mark.parametrize("mapped", [512, 1])
def test_against_brute_force(spark, mapped):
    df = spark.createDataFrame([(i, u, "old", "x") for i, u in URLS], "page_id long, url string, rule string, verdict string")
    got = sorted(((r.page_id, r.url, r.host, r.path, r.rule, r.verdict) for r in filter_urls(df, URL_RULES, mapped=mapped).collect()), key=str)
    assert got == sorted(((i, u, *brute(u)) for i, u in URLS), key=str)


def test_empty_table_and_no_rules(spark):
    df = spark.createDataFrame([], "page_id long, url string")
    assert filter_urls(df, URL_RULES).count() == 0
    assert [r.verdict for r in filter_urls(spark.createDataFrame([("http://a.b/",)], "url string"), [], default="block").collect()] == ["block"]


def test_open_path_segment_is_no_token():
    assert rule_tokens("a.com", "/en/fr") == ["h:a", "h:com", "p:en"]


@pytest.mark.parametrize("mapped", [512, 1])
def test_rules_without_a_token(spark, mapped):
    df = spark.createDataFrame([("file:///etc",), ("http://a.com/etc",)], "url string")
    got = {r.url: (r.rule, r.verdict) for r in filter_urls(df, [("block", "", "/etc"), ("allow", "com", "/"), ("block", "b.com", "/")], mapped=mapped).collect()}
    assert got == {"file:///etc": ("/etc", "block"), "http://a.com/etc": ("com/", "allow")}


@pytest.mark.parametrize("mapped", [1000, 1])
def test_many_rules(spark, mapped):
    """600 rules, some without a literal token, some that fit URLs without a host, against every rule on every URL."""
    rng = random.Random(3)
    names, parts = ["a", "b", "co", "x-y", "com", "net"], ["", "/", "/e", "/en/", "/en/fr/", "/q"]
    rules = [("block", "", "/"), ("allow", "", "/en/"), ("block", "", "")]
    while len(rules) < 600:
        host = ".".join(rng.choice([*names, f"h{rng.randrange(80)}"]) for _ in range(rng.randrange(1, 4)))
        rules.append((rng.choice(["allow", "block"]), host, rng.choice(parts)))
    urls = [f"http://{'.'.join(rng.choice([*names, f'h{rng.randrange(80)}']) for _ in range(rng.randrange(1, 5)))}{rng.choice(parts)}{rng.choice(['', 'z', '/en/'])}" for _ in range(400)] + ["http:///x", "file:///en/q", None, "", "no scheme"] * 3
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = sorted(((r.url, r.host, r.path, r.rule, r.verdict) for r in filter_urls(df, rules, mapped=mapped).collect()), key=str)
    assert got == sorted(((u, *brute(u)[:2], *judged(*brute(u)[:2], rules)) for u in urls), key=str)


@pytest.mark.parametrize("mapped", [512, 1])
def test_columns_of_any_name_pass_through(spark, mapped):
    names = ["_h", "_p", "_t", "_best", "_id", "best", "tokens", "token", "url_key", "rank", "salt", "times"]
    df = spark.createDataFrame([("http://com/", *names)], ["url", *names])
    row = filter_urls(df, URL_RULES, mapped=mapped).first()
    assert {n: row[n] for n in names} == {n: n for n in names} and (row.rule, row.verdict) == ("com/", "allow")


def test_a_host_with_a_control_character(spark):
    """No character of a host passes for its end, in either form of the index."""
    rows = [("http://a\x01.example.com/en/x", "example.com/en/"), ("http://a\n.example.com/en/", "example.com/en/"), ("http://example.com\x01/en/", None), ("http://x.net\n/es/", None)]
    df = spark.createDataFrame([(u,) for u, _ in rows], "url string")
    for mapped in (512, 0):
        got = {r.url: r.rule for r in filter_urls(df, [("block", "example.com", "/en/"), ("block", "net", "/es/")], mapped=mapped).collect()}
        assert got == dict(rows)
