"""The queries of this subpackage, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, divergence, jaccard_join, lines, packing, pii, quality, repair, toxicity, trie, urls, vectors, warc
from .common import table

URL_RULES = [urls.Rule("block", "com/en/"), urls.Rule("allow", "example.com/en/7"), urls.Rule("allow", "net/de/"), urls.Rule("block", "example.net/de/8"), urls.Rule("block", "org/es/")]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_texts(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, with_ids=False)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repetition(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find_pii(docs, pii.train(docs)).drop("found")


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("low")


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "lines_before", "lines_dropped", "text")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_tree(table(spark, sf_dir, "conversations"))


OP9_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS r FROM pages),
h AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rule, site, pre) AS (VALUES ('block', 'com/en/', 'com', '/en/'), ('allow', 'example.com/en/7', 'example.com', '/en/7'), ('allow', 'net/de/', 'net', '/de/'), ('block', 'example.net/de/8', 'example.net', '/de/8'), ('block', 'org/es/', 'org', '/es/')),
ruled AS (SELECT h.page_id, h.host, h.path, r.rule, r.verdict FROM h LEFT JOIN rules r ON (h.host = r.site OR ends_with(h.host, '.' || r.site)) AND starts_with(h.path, r.pre)
  QUALIFY row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule) DESC NULLS LAST) = 1),
hosts AS (SELECT host, count(verdict)::DOUBLE AS n, count(*) FILTER (verdict = 'block')::DOUBLE AS k, array_to_string(list_slice(string_split(regexp_replace(host, ':[0-9]*$', ''), '.'), -2, -1), '.') AS domain, string_split(regexp_replace(host, ':[0-9]*$', ''), '.')[-1] AS suffix FROM ruled GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY suffix),
whole AS (SELECT CASE WHEN sum(n) > 0 THEN sum(k) / sum(n) ELSE 0.5 END AS top FROM suffixes),
groups AS (SELECT 'h' AS level, n, k FROM hosts UNION ALL SELECT 'd', n, k FROM domains UNION ALL SELECT 's', n, k FROM suffixes),
moments AS (SELECT level, sum(n) AS a, sum(k) AS b, count(*) AS g, sum(k * k / n) AS q, sum(k) / sum(n) AS m FROM groups WHERE n > 0 GROUP BY level),
shares AS (SELECT level, m, CASE WHEN m <= 0 OR m >= 1 THEN NULL ELSE ((q - a * m * m) / (m * (1 - m)) - g) / nullif(a - g, 0) END AS share FROM moments),
strengths AS (SELECT l.level, least(1000.0, greatest(1.0, CASE WHEN s.share IS NULL OR s.share <= 0 THEN 1000.0 ELSE 1 / s.share - 1 END)) AS s FROM (VALUES ('h'), ('d'), ('s')) l(level) LEFT JOIN shares s ON l.level = s.level),
s1 AS (SELECT suffix, (k + s * top) / (n + s) AS above FROM suffixes, whole, strengths WHERE level = 's'),
d1 AS (SELECT domain, (k + s * above) / (n + s) AS above FROM domains JOIN s1 USING (suffix), strengths WHERE level = 'd'),
h1 AS (SELECT host, k + s * above AS a, n - k + s * (1 - above) AS b FROM hosts JOIN d1 USING (domain), strengths WHERE level = 'h'),
low AS (SELECT host, a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS low FROM h1)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END) AS verdict FROM ruled LEFT JOIN low USING (host)
"""

OP10_SQL = r"""
WITH split AS (SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
counts AS (SELECT source, line, count(*) AS pages FROM (SELECT source, unnest(list_distinct(parts)) AS line FROM split) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
gone AS (SELECT c.source, list(c.line) AS gone FROM counts c JOIN (SELECT source, count(*) AS n FROM documents GROUP BY source) t ON c.source IS NOT DISTINCT FROM t.source WHERE c.pages >= 3 AND c.pages > 0.10 * t.n GROUP BY c.source),
kept AS (SELECT doc_id, text, parts, CASE WHEN gone IS NULL THEN parts ELSE list_filter(parts, lambda x: NOT list_contains(gone, x)) END AS left_over FROM split s LEFT JOIN gone g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(parts) END::BIGINT AS lines_before, CASE WHEN text IS NULL THEN 0 ELSE len(parts) - len(left_over) END::BIGINT AS lines_dropped,
  CASE WHEN text IS NULL THEN NULL ELSE array_to_string(left_over, chr(10)) END AS text FROM kept
"""


OP11_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT *, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM cells),
q AS (SELECT *, 1 + 1000000000 * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM kept),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT s.lang, s.source, 'term' AS part, s.term AS item, (p - q)::BIGINT AS value FROM shares s JOIN q ON s.lang = q.lang AND s.term = q.term WHERE s.n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


OP13_SQL = r"""
WITH turns AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS at FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c FROM turns),
checked AS (SELECT c, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda y: ascii(y)::BIGINT)),
  lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)) AS crc FROM ids),
convs AS (SELECT c, c - c % 5 AS base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM checked),
sizes AS (SELECT v.c, v.h, v.base, least(v.h, count(t.c)) AS k FROM convs v LEFT JOIN turns t ON t.c = v.base GROUP BY v.c, v.h, v.base),
rebuilt AS (SELECT s.c, t.at + 1 AS d, r, x FROM sizes s JOIN turns t ON t.c = s.base AND t.at < s.h UNION ALL SELECT s.c, t.at - s.h + s.k + 1, r, x FROM sizes s JOIN turns t ON t.c = s.c AND t.at >= s.h),
prefixes AS (SELECT c, d, list({'r': r, 'x': x}) OVER (PARTITION BY c ORDER BY d) AS p, strlen(x) AS bytes FROM rebuilt UNION ALL SELECT c, 0, []::STRUCT(r VARCHAR, x VARCHAR)[], 0 FROM ids),
nodes AS (SELECT d, p, min(c) AS owner, count(*) AS n, any_value(bytes) AS bytes FROM prefixes GROUP BY d, p),
lasts AS (SELECT p, d, string_agg(c::VARCHAR, ',' ORDER BY c) AS members FROM prefixes SEMI JOIN (SELECT c, max(d) AS d FROM prefixes GROUP BY c) m ON prefixes.c = m.c AND prefixes.d = m.d GROUP BY p, d),
kids AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS children FROM nodes WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT n.*, coalesce(children, 0) AS children FROM nodes n LEFT JOIN kids k ON n.p = k.p),
up AS (SELECT unnest(range(0, d + 1)) AS i, p, n, bytes, children FROM full_),
sums AS (SELECT list_slice(p, 1, i) AS p, count(*) FILTER (children = 0) AS leaves, sum((n - 1) * bytes)::BIGINT AS saved FROM up GROUP BY ALL)
SELECT f.owner AS conv_id, f.d::BIGINT AS depth, CASE WHEN f.d > 0 THEN a.owner END AS parent_conv_id, f.n AS n_convs, f.children AS n_children, s.leaves AS n_leaves, s.saved AS saved_tokens, sha256(coalesce(l.members, '')) AS ends_sha256
FROM full_ f JOIN sums s ON s.p = f.p LEFT JOIN nodes a ON a.p = list_slice(f.p, 1, f.d - 1) AND a.d = f.d - 1 LEFT JOIN lasts l ON l.p = f.p
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_jaccard, op3_bpe, op4_packing, op5_toxicity, op6_quality, op7_pii, op8_vectors, op9_urls, op10_lines, op11_divergence, op12_repair, op13_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op9_urls": OP9_SQL, "op10_lines": OP10_SQL, "op11_divergence": OP11_SQL, "op13_trie": OP13_SQL}
