"""Sources and sinks.

Everything here is a distributed scan or write; nothing is read through the
driver. Parquet is the default table format (Delta is optional: pass
``fmt="delta"`` when the Delta jars are on the cluster).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.sources import versions, workbook
from tillroll.sources.schema import CORRUPT_COLUMN, PARTITIONED_BY, RAW_SCHEMA

DEFAULT_FORMAT = "parquet"


# CSV as spreadsheets write it: quotes inside a quoted cell are doubled.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False, **options) -> DataFrame:
    """A2: load raw invoice lines with the declared schema (no inference pass).

    CSV/JSON get the explicit schema, so a missing CustomerID is NULL, never
    NaN or the text 'nan'; a line that does not fit it keeps its text in
    ``_corrupt_record`` (counted by ``bronze_quality``). ``multi_line`` reads
    cells with line breaks (a file is then one task). Parquet/ORC files are read
    as stored and then conformed (missing raw columns become typed NULLs). ``xlsx``
    reads a workbook or a folder of them, a task per sheet (``sources.workbook``).
    """
    if fmt == "xlsx":
        workbook.register(spark)
        return spark.read.format(workbook.NAME).load(path)
    if fmt in ("csv", "json"):
        schema = StructType([*RAW_SCHEMA.fields, StructField(CORRUPT_COLUMN, StringType(), True)])
        reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        if fmt == "csv":
            reader = reader.options(**CSV_OPTIONS)
        return reader.option("multiLine", str(multi_line).lower()).options(**options).format(fmt).load(path)
    return conform_raw(spark.read.options(**options).format(fmt).load(path))


def conform_raw(df: DataFrame) -> DataFrame:
    """Cast/align any frame to the 8 raw columns (extra columns dropped)."""
    from pyspark.sql import functions as F

    cols = []
    present = set(df.columns)
    for field in RAW_SCHEMA.fields:
        if field.name in present:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*cols)


def rows_source(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A3: literal rows + column names -> table (a small hand-made input)."""
    return spark.createDataFrame(list(rows), list(columns))


def table_path(base: str, layer: str, name: str) -> str:
    return os.path.join(base, layer, name)


def write_table(
    df: DataFrame,
    base: str,
    layer: str,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] | None = None,
) -> str:
    """A4/A5: full overwrite (schema replaced), all at once: a new folder is filled
    and then published (``sources.versions``), so a failed write leaves the old
    table and a job may replace a table it reads. Partitioned tables from
    ``PARTITIONED_BY`` are written hive-style so readers prune partitions.
    Returns the folder that holds the rows; ``read_table`` finds the newest."""
    path = table_path(base, layer, name)
    cols = partition_by if partition_by is not None else PARTITIONED_BY.get((layer, name))
    if cols:
        # rows of a partition meet before the write: files follow the data's
        # size (AQE splits a big partition), not the number of tasks
        df = df.hint("rebalance", *cols)
    if fmt != "delta":
        return versions.replace_table(df, path, cols or (), fmt)
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    (writer.partitionBy(*cols) if cols else writer).save(path)
    return path


def write_partitioned(
    df: DataFrame, base: str, layer: str, name: str, cols: Sequence[str] = ("year", "month"),
    fmt: str = DEFAULT_FORMAT,
) -> str:
    """A5: as ``write_table`` but always hive-partitioned by ``cols``."""
    return write_table(df, base, layer, name, fmt=fmt, partition_by=list(cols))


def read_table(spark: SparkSession, base: str, layer: str, name: str, fmt: str = DEFAULT_FORMAT,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Load a stored table (its newest version). Partition columns come back
    last; ``columns`` puts them back in the declared order."""
    path = table_path(base, layer, name)
    df = versions.read_current(spark, path, fmt) if fmt != "delta" else None
    if df is None:
        df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV sink with header. ``single_file`` (coalesce(1)) is opt-in only:
    it funnels the whole table through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV source with header; every column is a string."""
    return spark.read.options(**CSV_OPTIONS).option("multiLine", str(multi_line).lower()).csv(path)
