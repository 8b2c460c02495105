"""The registered queries op1 to op13, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from landrecon.llm import bpe, contamination, hamming, language, negatives, order, packing, pii, simhash, substrings, toxicity, vectors, whitening
from landrecon.llm.common import finite, grid, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


@query("op8_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.decode(bpe.encode(table(spark, folder, "documents"), ranks), ranks)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer)


@query("op6_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


NEAR_VECTORS_SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda v: NOT isfinite(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id)::BIGINT AS n_links,
  (SELECT min(b) FROM reach r WHERE r.a = v.vec_id) AS component_id,
  v.vec_id = (SELECT min(b) FROM reach r WHERE r.a = v.vec_id) AS kept
FROM embeddings v
"""


@query("op3_embedding_near_dedup", NEAR_VECTORS_SQL)
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query("op10_suffix_dedup")
def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_pii_boosted")
def pii_boosted(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(table(spark, folder, "documents"))
    counts = [
        F.size(F.filter(F.col("base.kind"), pii.equals(n))).cast("long").alias(f"n_{kind}")
        for n, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_text("base"), 256).alias("base_sha256"), pii.span_text("spans").alias("spans")
    )


NEAREST_CODES_SQL = """
WITH whole AS (
  SELECT vec_id AS id, list_transform(embedding[1:64], lambda v: (v >= 0)::INT) AS code FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) >= 64 AND list_count(embedding[1:64]) = 64
), pairs AS (
  SELECT q.id AS query_id, t.id AS neighbor_id,
    list_sum(list_transform(list_zip(q.code, t.code), lambda p: (p[1] <> p[2])::INT))::INT AS distance
  FROM whole q, whole t WHERE q.id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank FROM pairs
)
SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
"""


@query("op1_hamming_top_k", NEAREST_CODES_SQL)
def hamming_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest sign codes of every vector whose id is divisible by 20, among all vectors."""
    codes = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    return hamming.nearest(codes, codes.filter(F.col("id") % 20 == 0))


@query("op2_training_order")
def training_order(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    stored = order.sequences(table(spark, folder, "documents"), bpe.encoder(ranks), end_id=50256)
    return order.materialised(order.in_training_order(stored, key=2024))


HARD_NEGATIVES_SQL = """
WITH whole AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding::DOUBLE[], lambda c: floor(256 * c)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND list_count(embedding) = len(embedding)
    AND len(list_filter(embedding, lambda v: NOT isfinite(v))) = 0
), scored AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM whole a JOIN whole b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INT AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query("op13_hard_negatives", HARD_NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """For every anchor (id divisible by 100) and each of its 5 positives, 10 negatives between 0.3
    and 0.9 of the positive's score. One label in seven is moved, so that labels do not follow the
    vectors alone."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, folder, "embeddings").filter(finite("embedding")).select(
        F.col("vec_id").alias("id"), moved.alias("label"), grid("embedding").alias("x")
    )
    return negatives.mine(rows, rows.filter(F.col("id") % 100 == 0))


@query("op12_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    unnest(list_transform(range(0, len(w) - least(len(w), 10) + 1), lambda i: array_to_string(w[i + 1 : i + least(len(w), 10)], ' '))) AS words
  FROM b WHERE len(w) > 0
), runs AS (
  SELECT row, size, unnest(range(0, len(w) - size + 1)) AS start,
    unnest(list_transform(range(0, len(w) - size + 1), lambda i: array_to_string(w[i + 1 : i + size], ' '))) AS words
  FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), hits AS (
  SELECT DISTINCT row, start, r.size, item_id FROM runs r JOIN windows USING (size, words)
), per_row AS (
  SELECT row, count(DISTINCT position) AS n_hit FROM (SELECT row, unnest(range(start, start + size)) AS position FROM hits) GROUP BY row
), per_item AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per_row USING (row) LEFT JOIN per_item USING (row)
"""


@query("op11_decontamination", CONTAMINATION_SQL)
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )
