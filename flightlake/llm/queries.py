"""The operators' queries: each applies its operator to whole tables and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import (
    bagminhash, bond, curve_packing, lpf_dedup, mixing, ordinal, packing, periodic_runs, pii_crf, pitman_yor, repetition,
    token_files, topk,
)
from flightlake.llm.runtime import table
from flightlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.token_spans(spark, docs, scratch_path(spark, "token-files"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


def op3_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_docs")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.find_pii(table(spark, sf_dir, "documents"))


def op5_lpf_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lpf_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(table(spark, sf_dir, "documents"))


def op8_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal.train(docs, ordinal.grade_labels(table(spark, sf_dir, "labels")))
    return ordinal.score(docs, model)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"), max_repeats=2.0)
    return mixed.select("doc_id", "source", "mix_block", "mix_tokens", "mix_pass", "mix_key")


def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.language_model_scores(table(spark, sf_dir, "documents"))


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curve_packing.pack_along_curve(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_bond(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return bond.mine_hard_negatives(vectors, F.col("vec_id") % 100 == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_periods(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_token_files": op2_token_files,
    "op3_bagminhash": op3_bagminhash,
    "op4_pii": op4_pii,
    "op5_lpf_dedup": op5_lpf_dedup,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_ordinal": op8_ordinal,
    "op9_mixing": op9_mixing,
    "op10_pitman_yor": op10_pitman_yor,
    "op11_curve_packing": op11_curve_packing,
    "op12_bond": op12_bond,
    "op13_periodic_runs": op13_periodic_runs,
}

#: DuckDB SQL, where SQL can express the operator; the others are tested against brute force
ORACLE_SQL: dict[str, str] = {
    "op1_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s
QUALIFY rank <= 5
""",
    "op12_bond": """
WITH v AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_inner_product(a.w, c.w)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)::INTEGER AS positive_rank
  FROM s WHERE alike
  QUALIFY positive_rank <= 5
)
SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score, p.positive_rank,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
""",
}
