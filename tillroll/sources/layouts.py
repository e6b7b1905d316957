"""Stored layouts that save a shuffle or a scan.

* Bucketed lines: clean lines dealt by CustomerID once, when they are written. Every
  aggregate per customer and the join with customer statistics then run where the
  lines lie. Guests (no CustomerID) would all fall into one bucket, so they are a
  partition of their own and read without buckets.
* Lookup tables: sorted by key, with small row groups and Parquet Bloom filters, so
  that one key is found by reading one row group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: fixes the key's type and hash; pick it once per table
BUCKETS = 8
ROW_GROUP_BYTES = 1 << 20


def write_bucketed(clean: DataFrame, table: str, path: str, buckets: int = BUCKETS, key: str = "CustomerID") -> DataFrame:
    """Store lines at ``path`` as catalog table ``table``, bucketed and sorted by
    ``key``; returns ``read_bucketed``. Rows are dealt to the buckets' tasks before the
    write, so each bucket is one file; a bucket is as large as its customers' lines."""
    known = clean.where(F.col(key).isNotNull()).repartition(buckets, key)
    (known.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", f"{path}/known").saveAsTable(table))
    clean.where(F.col(key).isNull()).write.mode("overwrite").parquet(f"{path}/guests")
    return read_bucketed(clean.sparkSession, table, path)


def register_bucketed(spark: SparkSession, table: str, path: str, like: DataFrame, buckets: int = BUCKETS, key: str = "CustomerID") -> None:
    """Make a stored bucketed table known to another session's catalog."""
    columns = ", ".join(f"`{c}` {t}" for c, t in like.dtypes)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet LOCATION '{path}/known' "
              f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")


def known_lines(spark: SparkSession, table: str) -> DataFrame:
    """Lines with a customer, dealt by customer."""
    return spark.table(table)


def guest_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/guests")


def read_bucketed(spark: SparkSession, table: str, path: str) -> DataFrame:
    """All lines (a union loses the buckets: use ``known_lines`` where they matter)."""
    return known_lines(spark, table).unionByName(guest_lines(spark, path))


def write_lookup(df: DataFrame, path: str, key: str, row_group_bytes: int = ROW_GROUP_BYTES) -> str:
    """Store ``df`` for lookups by ``key``: ranges of keys in files, sorted, small row
    groups with minima and maxima, and a Bloom filter of each row group's keys (also
    for keys that a sort cannot separate, such as a second column's)."""
    (df.repartitionByRange(F.col(key)).sortWithinPartitions(key).write.mode("overwrite")
     .option("parquet.bloom.filter.enabled", "false").option(f"parquet.bloom.filter.enabled#{key}", "true")
     .option("parquet.block.size", str(row_group_bytes)).option("parquet.page.row.count.limit", "1000")
     .parquet(path))
    return path


def lookup(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """The rows of one key."""
    return spark.read.parquet(path).where(F.col(key) == F.lit(value))
