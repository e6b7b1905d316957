"""Registered queries of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    alignment, chunks, licenses, manifest, near_dup, packing, piece_counts, pii, sharding, token_files, toxicity, vectors,
)
from tillroll.llm.common import table
from tillroll.session import ensure_checkpoint_dir


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, end_id=2)
    return token_files.token_digests(token_files.read_token_files(spark, path))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "group_bins", "group_bound")


def op3_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.hilbert_shards(table(spark, sf_dir, "documents"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.size("detections").alias("n_detections"))


def op5_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op6_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.digests(pii.find(docs, pii.train(docs)))


def op9_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.exact_top_k(table(spark, sf_dir, "embeddings"))


def op10_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.forest_top_k(table(spark, sf_dir, "embeddings"))


def op11_slot_pivot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return manifest.audit(docs, manifest.lowered_where_third(docs))


def op12_pre_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_counts.token_counts(table(spark, sf_dir, "documents"), limit=4096)


def op13_byte_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_counts(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e, len(embedding) AS dim FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND c.dim = q.dim),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM s)
SELECT * FROM r WHERE rank <= 5
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_hilbert_shards": op3_hilbert_shards,
        "op4_license_rules": op4_license_rules,
        "op5_chunked_bpe": op5_chunked_bpe,
        "op6_skip_chain_pii": op6_skip_chain_pii,
        "op7_lsh_forest": op7_lsh_forest,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_ordinal_toxicity": op9_ordinal_toxicity,
        "op10_projection_forest": op10_projection_forest,
        "op11_slot_pivot_manifest": op11_slot_pivot_manifest,
        "op12_pre_token_counts": op12_pre_token_counts,
        "op13_byte_alignment": op13_byte_alignment,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_exact_top_k": OP8_SQL, "op11_slot_pivot_manifest": manifest.AUDIT_SQL}
