"""Shards of documents along a Hilbert curve over their metadata.

Each dimension is quantised at the quantiles of all rows: numbers by a bounded
sketch, strings exactly, from the counts of their distinct values in order, whole
strings compared. The cells are numbered along a Hilbert curve, and the rows, in
curve order, are cut into runs whose counts are at most one apart. Neighbours on the curve are
neighbours in every dimension, so files of a run have narrow ranges in all of
them and readers can skip by any.

The order comes from one range exchange of narrow rows with the id and text hash
as last keys, so a cell that holds a third of the rows is split like any other.

Edge cases: nulls in a dimension come first (cell 0), strings of any length are
compared whole; null texts have size 1; very long texts only cost their size;
rows that are equal in all keys are interchangeable; extra columns are ignored
unless kept; no rows: no shards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillroll.operators.ranking import global_rank, range_tagged, tile_of_rank


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows, dimensions;
    values below 2^bits): the cell's bits are turned level by level into the
    orientation of the curve and read off as one number."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for i in range(dims):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = top
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def string_bounds(docs: DataFrame, names: Sequence[str], parts: int) -> dict[str, list[str]]:
    """The distinct quantiles 1/parts .. (parts - 1)/parts of each string column
    over its rows that are not null, whole strings in byte order. Rows collapse to
    distinct values with counts before they are sorted, so a hot value is one row;
    running counts come from range parts, and at most ``parts - 1`` strings a
    column reach the driver."""
    if not names:
        return {}
    values = F.array(*[F.col(n).cast("string") for n in names])
    counts = (
        docs.select(F.posexplode(values).alias("column", "value")).filter("value IS NOT NULL")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = range_tagged(counts, ["column", "value"])
    # one row per range part and column
    held = ranged.groupBy("_tr_pid", "column").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("column").orderBy("_tr_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("_tr_pid", "column", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"),
                         F.sum("held").over(Window.partitionBy("column")).alias("total"))
    upto = F.col("start") + F.sum("n").over(Window.partitionBy("_tr_pid", "column").orderBy("value"))
    running = ranged.join(F.broadcast(starts), ["_tr_pid", "column"]).select("column", "value", "total", upto.alias("upto"))
    reached = running.groupBy("column").agg(*[
        F.min(F.when(F.col("upto") * parts >= F.col("total") * i, F.col("value"))).alias(f"q{i}") for i in range(1, parts)])
    bounds: dict[str, list[str]] = {n: [] for n in names}
    for row in reached.collect():  # one row per column
        bounds[names[row["column"]]] = list(dict.fromkeys(row[1:]))
    return bounds


def _string_cell(name: str, bounds: Sequence[str]) -> Column:
    """How many bounds are not above the string (null: 0)."""
    value = F.col(name).cast("string")
    if not bounds:
        return F.lit(0.0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= value)), F.lit(0)).cast("double")


def hilbert_shards(docs: DataFrame, dimensions: Sequence[str] = ("lang", "source", "n_chars"), shards: int = 8,
                   bits: int = 5, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``,
    ``curve`` (place on the curve), ``shard`` and ``slot`` of every row, and the
    columns to ``keep`` as ``kept.<name>``."""
    text = F.coalesce("text", F.lit(""))
    strings = [d for d in dict.fromkeys(dimensions) if isinstance(docs.schema[d].dataType, StringType)]
    by_string = string_bounds(docs, strings, 2**bits)
    numbers = [F.col(d).cast("double") if d not in by_string else _string_cell(d, by_string[d]) for d in dimensions]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.struct(*[n.alias(f"d{i}") for i, n in enumerate(numbers)]).alias("place"),
        *([F.struct(*keep).alias("kept")] if keep else []),
    )
    shares = [i / 2**bits for i in range(1, 2**bits)]
    sketched = [i for i, d in enumerate(dimensions) if d not in by_string]
    bounds = rows.agg(F.count(F.lit(1)), *[F.percentile_approx(f"place.d{i}", shares, 10_000).alias(f"d{i}") for i in sketched]).first()
    # strings stand as the numbers of their cells
    edges = [np.unique(np.array(bounds[f"d{i}"] or [], float)) if i in sketched else np.arange(1, 2**bits) for i in range(len(dimensions))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fields = batch["place"].flatten()
            cells = [np.searchsorted(e, np.where(np.isnan(v), -np.inf, v), side="right") if len(e) else np.zeros(len(v))
                     for e, v in zip(edges, (f.to_numpy(zero_copy_only=False).astype(float) for f in fields))]
            curve = hilbert_index(np.stack(cells, axis=1), bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(curve, pa.int64())], [*batch.schema.names, "curve"])

    placed = rows.mapInArrow(run, rows.withColumn("curve", F.lit(0).cast("long")).schema).drop("place")
    ranked = global_rank(placed, ["curve", "doc_id", "text_crc32"], rank_col="_rank", total_col="_total")
    shard = tile_of_rank(F.col("_rank"), F.col("_total"), shards) - 1
    each, more = F.floor(F.col("_total") / shards), F.col("_total") % shards
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("_rank") - F.col("shard") * each - F.least(F.col("shard").cast("long"), more)).cast("long"))
        .drop("_rank", "_total")
    )


def write_shards(docs: DataFrame, path: str, dimensions: Sequence[str] = ("lang", "source", "n_chars"), shards: int = 8,
                 bits: int = 5, rows_per_file: int = 1_000_000) -> None:
    """Write all columns of ``docs`` in curve order, a folder per shard; files
    of a shard are runs of at most ``rows_per_file`` slots."""
    placed = hilbert_shards(docs, dimensions, shards, bits, keep=docs.columns)
    (
        placed.withColumn("_run", F.floor(F.col("slot") / rows_per_file))
        .repartition("shard", "_run").sortWithinPartitions("shard", "slot")
        .select("kept.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
        .write.partitionBy("_shard").parquet(path)
    )
