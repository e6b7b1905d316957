"""Shared pieces of the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import materialize

__all__ = ["materialize", "table", "texts", "top_lists", "groups_for", "frequent"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty); other columns are left out,
    whatever their names."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def groups_for(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows``."""
    return max(1, math.ceil(rows / per_group))


def top_lists(lists: DataFrame, key: str, block: str, item: str, k: int, blocks: int, fan_in: int = 16) -> DataFrame:
    """Tree merge of sorted lists, one per (``key``, ``block``): each step joins
    the lists of ``fan_in`` neighbouring blocks and keeps the first ``k`` items,
    until one list per key is left. No task sees more than ``fan_in * k`` items
    of a key at once."""
    merged = False
    while blocks > 1 or not merged:
        merged = True
        lists = (
            lists.withColumn(block, F.floor(F.col(block) / fan_in).cast("int"))
            .groupBy(key, block)
            .agg(F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_list(item)))), 1, k).alias(item))
        )
        blocks = math.ceil(blocks / fan_in)
    return lists.select(key, item)


def frequent(counts: DataFrame, column: str, at_most: int) -> Column:
    """Condition that marks the rows of ``counts`` with the largest values of
    ``column`` (1 or more), at most ``at_most`` of them: a size bound for what is
    broadcast, whatever the table's size. The values are counted in quarters of
    octaves, so what is not marked holds less than 2 parts in ``at_most`` of
    the column's sum. The histogram is a few hundred rows at most."""
    step = F.floor(F.log2(F.col(column)) * 4)
    steps = sorted(((r.step, r["count"]) for r in counts.groupBy(step.alias("step")).count().collect()), reverse=True)
    marked, lowest = 0, None
    for value, rows in steps:
        marked += rows
        if marked > at_most:
            break
        lowest = value
    return step >= lowest if lowest is not None else F.lit(False)
