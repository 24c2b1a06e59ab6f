"""The registered queries of this subpackage and their SQL.

Each query applies one operator, with production parameters, to the whole of its table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.chat_format import format_chats
from quillspark.llm.common import table
from quillspark.llm.embedding_dedup import embedding_links
from quillspark.llm.exact_dedup import exact_groups
from quillspark.llm.jaccard_join import jaccard_components
from quillspark.llm.line_dedup import drop_boilerplate
from quillspark.llm.packing import pack
from quillspark.llm.periodic_runs import periodic_runs
from quillspark.llm.piece_codec import encode_pieces
from quillspark.llm.prefix_trie import prefix_trie, rebuilt
from quillspark.llm.quality import fit, score
from quillspark.llm.quality_rules import apply_rules
from quillspark.llm.sharding import shard_groups
from quillspark.llm.url_filter import filter_urls

#: (verdict, host, path)
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file `name` lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_inner_product(e, e) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u AS a JOIN u AS b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), r AS (
  SELECT vec_id AS node, vec_id AS far FROM v UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.far
), c AS (SELECT node, min(far) AS component_id FROM r GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.node = v.vec_id
"""


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never train: crc32 of the id as text is 1 modulo 3."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_groups(table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP5_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), q AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), r(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), hit AS (
  SELECT page_id, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
  FROM q JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT q.page_id, q.host, q.path, hit.rule, coalesce(hit.verdict, 'allow') AS verdict
FROM q LEFT JOIN hit ON hit.page_id = q.page_id AND hit.k = 1
"""


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "only_shared", F.length("text").cast("long").alias("n_left"), F.sha2("text", 256).alias("text_sha256"))


OP6_SQL = """
WITH d AS (SELECT doc_id, source, text FROM documents),
l AS (SELECT doc_id, source, i, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)),
b AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
g AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (b.line IS NULL) AS rest, count(*) AS n_lines, count(b.line) AS n_gone,
    coalesce(sum(length(l.line)) FILTER (b.line IS NULL), 0) AS own_chars
  FROM l LEFT JOIN b ON l.line = b.line GROUP BY l.doc_id
), k AS (
  SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_gone > 0 AND own_chars = 0, false) AS only_shared, n_gone, rest, d.text
  FROM d LEFT JOIN g USING (doc_id)
), e AS (
  SELECT doc_id, n_lines, only_shared, CASE WHEN only_shared THEN 0 ELSE coalesce(n_gone, 0) END AS n_removed,
    CASE WHEN only_shared OR text IS NULL THEN text ELSE coalesce(rest, '') END AS text
  FROM k
)
SELECT doc_id, n_lines, n_removed, only_shared, length(text) AS n_left, sha256(text) AS text_sha256 FROM e
"""


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_pieces(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), F.xxhash64("begins", "ends").alias("spans_xxhash64"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, lower(trim(coalesce(role, ''))) AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL GROUP BY ALL
), t AS (
  SELECT conv_id, count(*) AS n_turns, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns,
    string_agg('<|' || CASE WHEN role = '' THEN 'unknown' ELSE role END || '|>' || chr(10) || replace(text, '<|', '< |') || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS chat
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, chat FROM t
WHERE NOT EXISTS (
  SELECT 1 FROM t AS o WHERE o.conv_id <> t.conv_id AND o.turns[1:t.n_turns] = t.turns AND (o.n_turns > t.n_turns OR (o.n_turns = t.n_turns AND o.conv_id < t.conv_id))
)
"""


WORD = r"[^\x20\x09-\x0D]+"


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text of `documents`, every tenth text (by the checksum of its id) made periodic from some word on.

    h is the checksum of the decimal doc_id and g is h div 10. Where h % 10 is 0 and the text has n words, each word from
    a = g % n on becomes the word (i - a) % p after a, p = 1 + (n - a) div (3 + g % 8).
    """
    checked = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    placed = checked.withColumn("words", words).withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    placed = placed.withColumn("a", F.expr("if(n > 0, g % n, null)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    periodic = F.expr("array_join(transform(sequence(0L, n - 1), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return placed.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    first = found.withColumn("longest", longest)
    return first.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = apply_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "reason")


OP12_SQL = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)
), r AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM g WHERE times > 1) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r ON r.doc_id = w.doc_id
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), v AS (
  SELECT lang, source, unnest([0, 1, 2, 3]) AS k,
    unnest([100 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words]) AS v
  FROM b WHERE NOT base_failed
), c AS (
  SELECT lang, source, k, (v >> greatest(0, length(bin(v)) - 7)) << greatest(0, length(bin(v)) - 7) AS v FROM v
), f AS (
  SELECT CASE WHEN grouping(source) = 0 THEN 0 WHEN grouping(lang) = 0 THEN 1 ELSE 2 END AS level, lang, source, k, count(*) AS docs,
    quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3
  FROM c GROUP BY GROUPING SETS ((lang, source, k), (lang, k), (k))
), h AS (
  SELECT level, lang, source, k, docs, q1 - 3 * greatest(q3 - q1, [40, 30, 150, 100][k + 1]) AS low, q3 + 3 * greatest(q3 - q1, [40, 30, 150, 100][k + 1]) AS high FROM f
), t AS (
  SELECT b.*, coalesce(o.low, l.low, a.low) AS low, coalesce(o.high, l.high, a.high) AS high,
    CASE b.k WHEN 0 THEN 100 * word_chars // n_words WHEN 1 THEN 1000 * n_symbols // n_words WHEN 2 THEN 1000 * n_dup_lines // n_lines ELSE 1000 * n_repeat_words // n_words END AS v
  FROM (SELECT *, unnest([0, 1, 2, 3]) AS k FROM b) AS b
  LEFT JOIN h AS o ON o.level = 0 AND o.k = b.k AND o.docs >= 100 AND o.lang IS NOT DISTINCT FROM b.lang AND o.source IS NOT DISTINCT FROM b.source
  LEFT JOIN h AS l ON l.level = 1 AND l.k = b.k AND l.docs >= 100 AND l.lang IS NOT DISTINCT FROM b.lang
  LEFT JOIN h AS a ON a.level = 2 AND a.k = b.k
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines,
  CASE WHEN base_failed THEN 'base' ELSE coalesce(string_agg(['chars_per_100_words', 'symbols_per_1000_words', 'dup_lines_per_1000', 'repeats_per_1000_words'][k + 1], ',' ORDER BY k) FILTER (v > high OR (k = 0 AND v < low)), '') END AS reason,
  NOT base_failed AND count(*) FILTER (v > high OR (k = 0 AND v < low)) = 0 AS kept
FROM t GROUP BY doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))


OP13_SQL = r"""
WITH t AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), CAST(4294967295 AS BIGINT)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), l AS (
  SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY part, pos) FILTER (r.pos IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), p AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM l
), m AS (
  SELECT conv_id, depth, turns[1:depth] AS prefix, depth = len(turns) AS ends, CASE WHEN depth > 0 THEN strlen(turns[depth].text) ELSE 0 END AS bytes FROM p
), n AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY depth, prefix
), u AS (
  SELECT n.*, q.conv_id AS parent_conv_id FROM n LEFT JOIN n AS q ON q.depth = n.depth - 1 AND q.prefix = n.prefix[1:n.depth - 1]
), k AS (
  SELECT u.depth, u.conv_id, count(v.conv_id) AS n_children FROM u LEFT JOIN u AS v ON v.depth = u.depth + 1 AND v.parent_conv_id = u.conv_id GROUP BY u.depth, u.conv_id
), s AS (
  SELECT a.depth, a.conv_id, count(*) FILTER (k.n_children = 0) AS n_leaves, CAST(sum((d.n_convs - 1) * d.bytes) AS BIGINT) AS saved_tokens
  FROM n AS d JOIN k ON k.depth = d.depth AND k.conv_id = d.conv_id JOIN m ON m.conv_id = d.conv_id AND m.depth <= d.depth JOIN n AS a ON a.depth = m.depth AND a.prefix = m.prefix
  GROUP BY a.depth, a.conv_id
)
SELECT u.conv_id, u.depth, u.parent_conv_id, u.n_convs, k.n_children, s.n_leaves, s.saved_tokens, u.ends_sha256
FROM u JOIN k ON k.depth = u.depth AND k.conv_id = u.conv_id JOIN s ON s.depth = u.depth AND s.conv_id = u.conv_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_url_filters": op5_url_filters,
    "op6_line_dedup": op6_line_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_chat_format": op10_chat_format,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_rules": op12_quality_rules,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op1_embedding_dedup": OP1_SQL,
    "op5_url_filters": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op10_chat_format": OP10_SQL,
    "op12_quality_rules": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
