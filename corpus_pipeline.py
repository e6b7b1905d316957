"""Corpus pipeline: toxicity, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
``run`` writes every stage's result as Parquet below spark.checkpoint.dir and
reads it again as the next one's documents. The first three return the columns
of ``documents``; the last returns packed pieces (see ``tillroll.llm.packing``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import near_dup, packing, pii, toxicity
from tillroll.llm.common import materialize, table

#: near duplicates share at least this many percent of their five-word shingles
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on ``labels``, rejects go. Null and
    empty texts hold no marked words and stay, as do rows without an id; very long
    texts are scored whole; repeated rows share their fate; other columns are kept
    whatever their names; no rows: no rows."""
    return toxicity.reject_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest ``doc_id`` stays; texts
    without words are no duplicates of anything. Rows that repeat a kept id and
    its text stay as one; rows without an id cannot be told apart and all stay. Null
    and empty texts stay; a very long text is one document like any other. Own
    columns live beside the document, packed into one struct, so no column's name
    can clash. No rows: no rows."""
    found = near_dup.near_duplicates(docs, percent=NEAR_PERCENT)
    kept = found.filter("kept").select("doc_id").distinct().hint("merge")
    packed = docs.select("doc_id", F.xxhash64("text").alias("digest"), F.struct(*docs.columns).alias("whole"))
    stays = packed.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "digest"])
    return stays.unionByName(packed.filter("doc_id IS NULL")).select("whole.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; every document stays. A null text stays
    null and an empty one empty; very long texts are searched whole; repeated rows
    are redacted alike; other columns are kept whatever their names; no rows: no rows."""
    return pii.redact(docs, pii.train(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 2048 tokens. A null or empty text is
    its end id alone; longer texts are cut into pieces; repeated rows and rows
    without an id are packed each; other columns are left out; no rows: no sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: models and approximate neighbours are not SQL: tests hold the stages to brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
