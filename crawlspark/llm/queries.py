"""The registered queries of the thirteen operators and their SQL. Each reads its whole table.

Not in SQL, so tested against brute force, round trips or held-out rows in tests/llm: op2, op4 and op9
(learned or keyed), op3 and op8 (hashes that DuckDB does not have), op6 (longest repeats), op7 (tokens).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlspark.llm import (
    filter_audit,
    hyperminhash,
    language,
    mixing,
    packing,
    pii,
    prefix_trie,
    repetition,
    simhash,
    topk,
    toxicity,
    url_filter,
    warc,
)
from crawlspark.llm.common import table
from crawlspark.llm.url_filter import Rule, host_of

RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

# Sites whose URLs make up the list of the URL filter, by a label of their host
LISTED_SITES = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


#: Decides the surrogates of the test tables. Real texts need a secret one.
SURROGATE_KEY = b"key of the test tables"


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best others of every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, with the nearest labelled examples."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mix of the sources takes."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data, and how many."""
    replaced = pii.with_surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)
    counts = F.aggregate(F.map_values("__kinds"), F.lit(0), lambda a, b: a + b)
    return replaced.select("doc_id", "text", F.coalesce(counts, F.lit(0)).alias("n_entities"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the list holds the URLs of the listed sites."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(F.arrays_overlap(F.split(host_of(F.col("url")), r"\."), F.lit(LISTED_SITES)))
    judged = url_filter.filter_urls(pages, listed.select("url"), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition in every document, and whether it is kept."""
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, after a round trip through archives."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document, and whether the document is kept."""
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, step by step in every order."""
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_NAMED = (
    op1_top_k,
    op2_toxicity,
    op3_mix_sources,
    op4_pii_surrogates,
    op5_url_filter,
    op6_repetition,
    op7_pack,
    op8_simhash,
    op9_language,
    op10_warc,
    op11_prefix_trie,
    op12_hyperminhash,
    op13_filter_audit,
)
QUERIES = {query.__name__: query for query in _NAMED}

OP1 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP5 = """
WITH a AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS s
  FROM pages
), b AS (
  SELECT page_id,
    translate(regexp_extract(s, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(s, '^[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(string_split(regexp_extract(s, '^[^?#]*[?]([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|gclid|fbclid)='))) AS params
  FROM a
), c AS (
  SELECT page_id, host, path,
    regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS key,
    list_has_any(string_split(host, '.'),
      ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) AS bad,
    CASE
      WHEN suffix('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN suffix('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN suffix('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN suffix('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN suffix('.' || host, '.org') AND starts_with(path, '/') THEN 'org/'
    END AS rule
  FROM b
), listed AS (SELECT DISTINCT key FROM c WHERE bad AND key <> '')
SELECT page_id, host, path, rule,
  CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN key IN (SELECT key FROM listed) THEN 'block'
    ELSE 'allow'
  END AS verdict
FROM c
"""

OP10 = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
  FROM pages
), g AS (SELECT *, max(page_id) OVER (PARTITION BY h, payload_bytes) AS newest FROM p),
d AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31)
    AS INTEGER), 1)), '') AS digest
  FROM g
)
SELECT page_id, payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM newest THEN newest END AS refers_to,
  true AS digest_ok
FROM d
"""

OP11 = r"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS ref
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, ref, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, ref) AS i FROM t
), c AS (
  SELECT conv_id, (4294967295 - list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1),
      lambda k: CAST(ascii(substr(conv_id::VARCHAR, CAST(k AS INTEGER), 1)) AS BIGINT)),
    lambda s, b: list_reduce(range(0, 8),
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(s, b)),
    4294967295)) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, false AS own, i, ref, chars FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 100 AND i <= h
  UNION ALL
  SELECT c.conv_id, true, i, ref, chars FROM c JOIN o ON o.conv_id = c.conv_id AND i > h
), s AS (
  SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(ref, '') OVER w AS path
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, i)
), m AS (
  SELECT conv_id, depth, sha256(path) AS path, coalesce(lag(sha256(path)) OVER (PARTITION BY conv_id ORDER BY depth), '') AS up,
    chars, depth = max(depth) OVER (PARTITION BY conv_id) AS ends
  FROM s
  UNION ALL
  SELECT conv_id, 0, '', NULL, 0, conv_id NOT IN (SELECT conv_id FROM s) FROM c
), n AS (
  SELECT depth, path, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(chars) AS worth,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM m GROUP BY depth, path
), k AS (
  SELECT n.*, (SELECT count(*) FROM n x WHERE x.depth = n.depth + 1 AND x.up = n.path) AS n_children FROM n
), a AS (
  SELECT m.depth, m.path, sum(worth) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM k JOIN m ON m.conv_id = k.conv_id AND m.depth <= k.depth GROUP BY m.depth, m.path
)
SELECT k.conv_id, k.depth, p.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN a USING (depth, path) LEFT JOIN n p ON p.depth = k.depth - 1 AND p.path = k.up
"""

OP12 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), d AS (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 1),
      lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])))
    END AS shingles
  FROM w
), n AS (
  SELECT row_number() OVER () AS node, shingles, len(shingles) AS n, min(doc_id) AS first
  FROM d WHERE len(shingles) > 0 GROUP BY shingles
), s AS (SELECT node, n, unnest(shingles) AS shingle FROM n),
links AS (
  SELECT a.node AS a, b.node AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.node <> b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT node AS a, node AS b FROM n
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), c AS (SELECT r.a AS node, min(n.first) AS component_id FROM reach r JOIN n ON n.node = r.b GROUP BY r.a)
SELECT doc_id, CAST(len(d.shingles) AS BIGINT) AS n_shingles,
  CASE WHEN len(d.shingles) > 0 THEN component_id ELSE doc_id END AS component_id,
  doc_id IS NOT DISTINCT FROM (CASE WHEN len(d.shingles) > 0 THEN component_id ELSE doc_id END) AS kept
FROM d LEFT JOIN n USING (shingles) LEFT JOIN c USING (node)
"""

OP13 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT doc_id, part,
    CAST(len(words) < 200 AS INTEGER)
      | (CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INTEGER) << 1)
      | (CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS INTEGER) << 2)
      | (CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER) << 3)
      | (CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INTEGER) << 4) AS mask
  FROM d
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), cells AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
walk AS (
  SELECT '' AS prefix, 0 AS step, 0 AS before, 0 AS bit
  UNION ALL
  SELECT prefix || letter, step + 1, before | w.bit, l.bit
  FROM walk w JOIN letters l ON (before | w.bit) & l.bit = 0
), steps AS (
  SELECT part, prefix, step, w.bit,
    CAST(coalesce(sum(n) FILTER (mask & (before | w.bit) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & w.bit <> 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (mask & before <> 0 AND mask & w.bit <> 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = w.bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & w.bit <> 0 AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (mask & before = 0 AND mask & w.bit <> 0 AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM walk w JOIN cells ON step > 0 GROUP BY ALL
), orders AS (
  SELECT s.*, o.prefix AS filter_order
  FROM (SELECT prefix FROM walk WHERE step = 5) o JOIN steps s ON starts_with(o.prefix, s.prefix)
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM orders
"""

SQL = {
    "op1_top_k": OP1,
    "op5_url_filter": OP5,
    "op10_warc": OP10,
    "op11_prefix_trie": OP11,
    "op12_hyperminhash": OP12,
    "op13_filter_audit": OP13,
}
