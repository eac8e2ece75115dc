"""The registered queries of the text operators: each operator on its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import (
    divergence,
    langid,
    mixing,
    neardup,
    packing,
    quality_rules,
    secret_scan,
    topk,
    toxicity,
    warc,
    weak_quality,
    whitening,
    word_tokens,
)

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents")).documents
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "n_slots", "first_position")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.train(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return weak_quality.classify(docs, weak_quality.train(docs))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve_pages(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_token_counts, op3_toxicity, op4_packing, op5_top_k, op6_near_duplicates, op7_mixing, op8_secrets,
        op9_quality, op10_quality_rules, op11_divergence, op12_whitening, op13_warc,
    )
}

# Top-k over quantised vectors: every row is a candidate but the query's own.
TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS query_row, q.vec_id AS query_id, c.vec_id AS vec_id, c.r AS r,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, r) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= 5
"""

# Near duplicates by the full sets of shingles: all pairs that share a shingle, and reachability over the links.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' '))) END AS s
  FROM words
), exploded AS (SELECT doc_id, unnest(s) AS shingle FROM shingled),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM exploded a JOIN exploded b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN shingled x ON x.doc_id = a.doc_id JOIN shingled y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, len(x.s), len(y.s)
  HAVING 100 * count(*) >= 80 * (len(x.s) + len(y.s) - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM shingled s JOIN least_id m USING (doc_id)
"""

# Quality rules: the measures of each text, lines by their normalised text, documents of a host by their text.
QUALITY_RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), repeated AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM twice) GROUP BY r
), lines AS (
  SELECT r, host, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    trim(regexp_replace(translate(lower(line), '123456789', '000000000'),
      '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'), ' ') AS norm
  FROM (SELECT r, host, t, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), hosts AS (
  SELECT host, count(DISTINCT t) AS docs FROM d GROUP BY host
), often AS (
  SELECT l.host, l.norm
  FROM (SELECT host, norm, count(DISTINCT t) AS docs FROM lines GROUP BY host, norm) l
  JOIN hosts h ON l.host IS NOT DISTINCT FROM h.host
  WHERE l.docs > 25 AND l.docs * l.docs > h.docs
), by_lines AS (
  SELECT l.r, count(*) - count(DISTINCT l.line) AS dup, sum(CASE WHEN o.norm IS NULL THEN 0 ELSE l.n END) AS removed
  FROM lines l LEFT JOIN often o ON l.host IS NOT DISTINCT FROM o.host AND l.norm = o.norm
  GROUP BY l.r
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
  FROM words LEFT JOIN repeated USING (r) LEFT JOIN by_lines USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND (n_words - removed_words) * 100 >= n_words * 30 AND n_words - removed_words >= 50 AS kept, removed_words
FROM measured
"""

# Source divergence: p of every source and kept term, all pairs of sources over them.
DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), words AS (
  SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT r) >= 30
), counts AS (
  SELECT w.lang, w.source, w.term, count(*) AS c FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
), langs AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), sources AS (
  SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts c ON g.lang = c.lang AND g.source = c.source
  GROUP BY g.lang, g.source
), p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5)) // (s.n + 5 * l.v) AS BIGINT) AS p,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * (k.c + 5)) // (l.n + 5 * l.v) AS BIGINT) AS q
  FROM sources s JOIN langs l ON s.lang = l.lang JOIN kept k ON s.lang = k.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found
QUALIFY part = 'pair' OR rank <= 50
"""

# Revisits: pages with equal payloads, and the SHA-1 in base32 by twenty bits at a time.
WARC_SQL = """
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(html, '') AS payload FROM pages
), hashed AS (
  SELECT r, page_id, payload, strlen(payload) AS payload_bytes, sha1(payload) AS h FROM p
), digested AS (
  SELECT *, list_aggregate(list_transform(range(0, 8), lambda j:
      list_aggregate(list_transform([15, 10, 5, 0], lambda s:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, CAST(1 + 5 * j AS BIGINT), 5) AS BIGINT) >> s) & 31 AS BIGINT), 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM hashed
), chosen AS (
  SELECT *, first_value(page_id) OVER w AS response_id, row_number() OVER w AS place
  FROM digested WINDOW w AS (PARTITION BY payload ORDER BY page_id DESC NULLS LAST, r)
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN response_id END AS refers_to
FROM chosen
"""

ORACLE = {
    "op5_top_k": TOP_K_SQL,
    "op6_near_duplicates": NEAR_DUPLICATES_SQL,
    "op10_quality_rules": QUALITY_RULES_SQL,
    "op11_divergence": DIVERGENCE_SQL,
    "op13_warc": WARC_SQL,
}
