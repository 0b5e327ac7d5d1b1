"""The registered queries of the operators, one for each, and the SQL that some of them must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, collocations, embedding_dedup, exact_dedup, filter_audit, html, language, mixing, quality, secrets, simhash, token_counts, top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query()
def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query(r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW same AS (PARTITION BY norm)
""")
def op2_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf, "documents"))


@query()
def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = secrets.scan_secrets(_table(spark, sf, "documents"), path, pattern)

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@query()
def op4_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@query(r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op5_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k.exact_top_k(_table(spark, sf, "embeddings"))


@query()
def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(_table(spark, sf, "documents"))


@query()
def op7_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_dedup(_table(spark, sf, "documents")).drop("kept")


@query()
def op8_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return encoded_digests(_table(spark, sf, "documents"))


def encoded_digests(docs: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Documents encoded and decoded again: n_tokens and the digests of ids and bytes, and the ids if wanted."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(docs, path, pattern).select(
        "doc_id",
        *(["ids"] if keep_ids else []),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.extract_text(_table(spark, sf, "pages")).withColumn("n_chars", F.length("text").cast("long"))


@query(r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 15)
              AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST([5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS BIGINT) AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, CAST(coalesce(sum(source_size) OVER before, 0) AS BIGINT) AS stopped,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS BIGINT) AS weights,
         CAST(sum(source_size) OVER () AS BIGINT) AS total,
         row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k
  FROM s WINDOW before AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), u AS (
  SELECT arg_min((total - 3 * stopped) / weights, k) FILTER (
           (total - 3 * stopped) / weights * weight < 3 * source_size) AS unit FROM r
), g AS (
  SELECT source, source_size,
         CASE WHEN unit * weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE unit * weight END AS target
  FROM s, u
), b AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM g
), c AS (
  SELECT d.source, h, sum(size) AS words,
         coalesce(sum(sum(size)) OVER (PARTITION BY d.source ORDER BY h
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d GROUP BY d.source, h
), t AS (
  SELECT c.source, h,
         before + words <= target - base * source_size
         OR before <= target - base * source_size AND 2 * (target - base * source_size - before) >= words AS more
  FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (base + CASE WHEN more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
       JOIN t ON d.source IS NOT DISTINCT FROM t.source AND d.h = t.h
""")
def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_table(spark, sf, "documents")).drop("copies")


@query(r"""
WITH p AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents
), w AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT lang, unnest(pieces) AS piece FROM p)
), s AS MATERIALIZED (
  SELECT piece, lang, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), o AS MATERIALIZED (
  SELECT lang, word AS w1, lead(word, 1) OVER p AS w2, lead(word, 2) OVER p AS w3, lead(word, 3) OVER p AS w4,
         lead(word, 4) OVER p AS w5
  FROM s WINDOW p AS (PARTITION BY piece ORDER BY i)
), g AS MATERIALIZED (
  SELECT lang, 1 AS m, w1 AS phrase, count(*) AS a FROM o GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 AS phrase, count(*) FROM o WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 AS phrase, count(*) FROM o WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) AS phrase, count(*) FROM o WHERE w4 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 5, concat_ws(' ', w1, w2, w3, w4, w5) AS phrase, count(*) FROM o WHERE w5 IS NOT NULL GROUP BY ALL
), t AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM g WHERE m = 1 GROUP BY lang
), h AS MATERIALIZED (
  SELECT lang, phrase, a FROM g WHERE a >= 100
), c AS MATERIALIZED (
  SELECT lang, m, phrase, a, string_split(phrase, ' ') AS words FROM g WHERE m > 1 AND a >= 100
), k AS (
  SELECT c.*, k.k, array_to_string(words[1 : k.k], ' ') AS head, array_to_string(words[k.k + 1 :], ' ') AS rest
  FROM c JOIN range(1, 5) k(k) ON k.k < m
), q AS (
  SELECT k.*, x.a AS l, y.a AS r, n, CAST(CAST(1000 AS HUGEINT) * k.a * n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM k JOIN t USING (lang) JOIN h x ON x.lang = k.lang AND x.phrase = k.head JOIN h y ON y.lang = k.lang AND y.phrase = k.rest
), b AS MATERIALIZED (
  SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), d AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM c WHERE c.lang = b.lang AND c.m > b.m AND c.a >= b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM d QUALIFY rank <= 2000
""")
def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf, "documents"))


@query(r"""
WITH w AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, coalesce(quality = 1, false) AS good,
         coalesce(toxic = 1, false) AS toxic, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents d LEFT JOIN (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS quality, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id
  ) l ON d.doc_id = l.doc_id
), f AS (
  SELECT part, good, toxic, list_concat(
    CASE WHEN len(words) < 200 THEN ['A'] ELSE [] END,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN ['B'] ELSE [] END,
    CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN ['C'] ELSE [] END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN ['D'] ELSE [] END,
    CASE WHEN coalesce(min(doc_id) OVER (PARTITION BY text) < coalesce(doc_id, 9223372036854775807), false) THEN ['E'] ELSE [] END
  ) AS fails FROM w
), m AS MATERIALIZED (
  SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL
), l(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a JOIN l b ON b.x <> a.x JOIN l c ON c.x NOT IN (a.x, b.x)
  JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS x, string_split(filter_order[1 : step - 1], '') AS before
  FROM o, range(1, 6) r(step)
), t AS (
  SELECT part, filter_order, step, x,
         sum(CASE WHEN NOT list_has_any(fails, before) AND NOT list_contains(fails, x) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = [x] THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN good AND NOT list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN toxic AND NOT list_has_any(fails, before) AND list_contains(fails, x) THEN n ELSE 0 END) AS toxic_lost
  FROM m, s GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM t
""")
def op12_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_filters(spark, f"{sf}/documents.parquet", _table(spark, sf, "labels"))


@query()
def op13_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(_table(spark, sf, "embeddings"))
