"""Exact global ranking and ``ntile`` without a single-partition window.

``Window.orderBy(x)`` with no ``partitionBy`` moves every row into one task.
Here the total order is produced the way a distributed sort does it:

1. ``repartitionByRange`` on the full sort key (value + a unique tie-break) —
   the sampled bounds split even a value shared by a third of the rows, because
   the tie-break column is part of the key;
2. ``sortWithinPartitions`` on the same key; the position inside a partition is
   ``monotonically_increasing_id() - (partition_id << 33)``;
3. per-partition row counts (one row per partition) -> running offsets;
   that table is bounded by the partition count, so it is broadcast;
4. global 0-based rank = offset + position.

The ranged, position-tagged table is written once as a table under the
session's reliable checkpoint directory before it is read twice (counts and
rows): range bounds come from a sample whose seed depends on the exchange
instance, so two evaluations could split differently. Reading one materialised copy makes the
ranks exact whatever the planner reuses, cuts the lineage, and survives a lost
executor. Only balance depends on the sample.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize

_PID = "_tr_pid"
_POS = "_tr_pos"
_OFF = "_tr_off"
_N = "_tr_n"


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sort_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]


def range_tagged(df: DataFrame, order: Sequence[str | Column],
                 num_partitions: int | None = None) -> DataFrame:
    """Steps 1-2, stored: rows range-partitioned and sorted on ``order`` with
    their partition id (``_tr_pid``) and position in it (``_tr_pos``)."""
    keys = _sort_cols(order)
    pid = F.spark_partition_id()
    return materialize(
        df.repartitionByRange(_partitions(df, num_partitions), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PID, pid)
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)),
        "ranked",
    )


def global_rank(
    df: DataFrame,
    order: Sequence[str | Column],
    rank_col: str = "_rank",
    total_col: str | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    ``order`` must be unique per row (add a key column as the last entry);
    ``total_col`` (optional) receives the total row count."""
    ranged = range_tagged(df, order, num_partitions)
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_tr_cnt"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum("_tr_cnt").over(before), F.lit(0)).alias(_OFF),
        F.sum("_tr_cnt").over(Window.partitionBy()).alias(_N),
    )
    out = ranged.join(F.broadcast(offsets), _PID).withColumn(
        rank_col, F.col(_OFF) + F.col(_POS)
    )
    if total_col:
        out = out.withColumnRenamed(_N, total_col)
    return out.drop(_PID, _POS, _OFF, _N)


def tile_of_rank(rank: Column, total: Column, k: int) -> Column:
    """ntile(k) from a 0-based rank r among n rows: the first n mod k tiles
    hold n div k + 1 rows, the rest n div k (standard NTILE semantics)."""
    s = F.floor(total / F.lit(k)).cast("long")
    m = (total - s * F.lit(k)).cast("long")
    big = s + 1
    first = F.floor(rank / big) + 1
    rest = F.floor((rank - m) / F.greatest(s, F.lit(1))) + 1
    return F.when(rank < m * big, first).otherwise(rest).cast("int")


def ntile_exact(
    df: DataFrame,
    order: Sequence[str | Column],
    k: int,
    out_col: str,
    num_partitions: int | None = None,
) -> DataFrame:
    """``ntile(k) OVER (ORDER BY order)`` computed without a single partition."""
    ranked = global_rank(df, order, rank_col="_tr_rank", total_col="_tr_total",
                         num_partitions=num_partitions)
    return ranked.withColumn(
        out_col, tile_of_rank(F.col("_tr_rank"), F.col("_tr_total"), k)
    ).drop("_tr_rank", "_tr_total")


def _not_above(place: Column):
    return lambda start: start <= place


def ntiles(df: DataFrame, key: str, values: dict[str, str], k: int,
           num_partitions: int | None = None) -> DataFrame:
    """Several ``ntile(k) OVER (ORDER BY value, key)`` columns at once:
    ``values`` maps the new column to the value's column; ``key`` is unique.

    One narrow table (measure, value, key) is ranked for all measures. Only the
    first row of each tile matters: those at most ``k`` keys per measure come
    back as one broadcast row, and a row's tile is the number of them that are
    not above it. The wide input is neither shuffled nor stored."""
    names = list(values)
    if not names:
        return df
    narrow = df.select(
        F.col(key).alias("_tr_key"),
        F.posexplode(F.array(*[F.col(values[n]).cast("double") for n in names])).alias("_tr_m", "_tr_v"),
    )
    ranked = global_rank(narrow, ["_tr_m", "_tr_v", "_tr_key"], rank_col="_tr_rank", total_col="_tr_total",
                         num_partitions=num_partitions)
    n = F.floor(F.col("_tr_total") / len(names))
    within = F.col("_tr_rank") - F.col("_tr_m") * n
    first = (within == 0) | (tile_of_rank(within, n, k) != tile_of_rank(within - 1, n, k))
    place = F.struct(F.col("_tr_v"), F.col("_tr_key"))
    starts = ranked.filter(first).agg(*[
        F.collect_list(F.when(F.col("_tr_m") == i, place)).alias(f"_tr_s{i}") for i in range(len(names))
    ])
    out = df.crossJoin(F.broadcast(starts))
    for i, name in enumerate(names):
        own = F.struct(F.col(values[name]).cast("double").alias("_tr_v"), F.col(key).alias("_tr_key"))
        out = out.withColumn(name, F.size(F.filter(f"_tr_s{i}", _not_above(own))))
    return out.drop(*[f"_tr_s{i}" for i in range(len(names))])


def quantiles(df: DataFrame, value: str, keys: Sequence[str], percents: Sequence[int],
              num_partitions: int | None = None) -> DataFrame:
    """One row ``_tr_q``: the exact lower quantiles of the non-NULL values, i.e.
    those at rank ceil(percent * n / 100), from the distributed ranking."""
    ranked = global_rank(df.select(value, *keys).filter(F.col(value).isNotNull()), [value, *keys],
                         rank_col="_tr_rank", total_col="_tr_total", num_partitions=num_partitions)
    at = [F.floor((F.col("_tr_total") * p + 99) / 100) - 1 for p in percents]
    return ranked.agg(F.array(*[F.max(F.when(F.col("_tr_rank") == a, F.col(value))) for a in at]).alias("_tr_q"))
