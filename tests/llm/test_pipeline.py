"""The pipeline's stages, each on its own input, and the registered queries."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odd import empty_documents, odd_documents
from tillroll.llm import pii, queries
from tillroll.llm.common import table
from test_documents import brute_components

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SMALL, "documents")
    kept = corpus_pipeline.drop_toxic(spark, docs, SMALL)
    labels = {r.doc_id: r.toxic for r in table(spark, SMALL, "labels").collect()}
    left = {r.doc_id for r in kept.collect()}
    clean = [d for d, t in labels.items() if t == 0]
    assert kept.columns == docs.columns and sum(d in left for d in clean) >= 0.98 * len(clean)
    single = corpus_pipeline.drop_near_duplicates(spark, kept, SMALL)
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    assert sorted(r.doc_id for r in single.collect()) == sorted(d for d, _, _, k in brute_components(rows, 80) if k)
    assert single.columns == docs.columns
    masked = corpus_pipeline.redact_personal_data(spark, single, SMALL)
    assert masked.columns == docs.columns and masked.count() == single.count()
    assert not any(pii.base_spans(r.text) for r in masked.collect())
    packed = corpus_pipeline.pack_sequences(spark, masked, SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in masked.collect()}


def test_stages_on_odd_rows(spark):
    for docs, n in ((odd_documents(spark), 9), (empty_documents(spark), 0)):  # 4 and 5 are like 3, 6 repeats
        for _, stage in corpus_pipeline.STAGES[:3]:
            docs = stage(spark, docs, SMALL)
        assert docs.count() == n and corpus_pipeline.pack_sequences(spark, docs, SMALL).select("doc_id").distinct().count() == n


def test_stages_with_clashing_names(spark):
    docs = odd_documents(spark)
    for name in ("_text", "_tr_rank", "id", "digest", "d0", "kept", "whole", "row", "words", "unit", "component_id"):
        docs = docs.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns
        docs = out
    assert docs.count() == 9 and docs.filter("_text <> '_text' OR kept <> 'kept' OR digest <> 'digest'").count() == 0
    assert corpus_pipeline.pack_sequences(spark, docs, SMALL).count() >= 9


CONTRACT = {
    "op1_token_files": "doc_id start n_tokens ids_crc32",
    "op2_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op3_hilbert_shards": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_license_rules": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op5_chunked_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_skip_chain_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op7_lsh_forest": "doc_id n_shingles component_id kept",
    "op8_exact_top_k": "query_id rank vec_id score",
    "op10_projection_forest": "query_id rank vec_id score",
}
TYPES = {"piece": "int", "shard": "int", "grown_shard": "int", "rank": "int", "kept": "boolean", "law": "string", "labels": "string",
         "base_labels": "string", "spans": "string", "ids_sha256": "string", "decoded_sha256": "string", "base_sha256": "string"}


@pytest.mark.parametrize("name", CONTRACT)
def test_registered_columns(spark, name):
    got = queries.queries()[name](spark, SMALL)
    want = CONTRACT[name].split()
    assert got.columns[:len(want)] == want
    types = dict(got.dtypes)
    assert {c: types[c] for c in want if c != "score"} == {c: TYPES.get(c, "bigint") for c in want if c != "score"}
    docs = table(spark, SMALL, "documents").count()
    if "doc_id" in want and "piece" not in want:
        assert got.count() == docs
    if name == "op1_token_files":  # each document's end id is part of its count
        sizes = sorted(map(tuple, got.select("start", "n_tokens").collect()))
        assert all(a + n == b for (a, n), (b, _) in zip(sizes, sizes[1:])) and min(n for _, n in sizes) >= 1
    if name == "op3_hilbert_shards":
        rows = got.collect()
        assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
        per = Counter(r.shard for r in rows)
        assert max(per.values()) - min(per.values()) <= 1


def test_registered_queries():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{i}" for i in range(1, 14)), "pipeline"]
    assert set(queries.oracle_sql()) <= set(names)
    assert len(corpus_pipeline.STAGES) == 4
