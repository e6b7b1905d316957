"""Ingestion (bronze): lineage columns, record hash, quality summary."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.columns import record_hash
from tillroll.sources.io import read_raw, read_table, write_table
from tillroll.sources.schema import BRONZE_VERSION, CORRUPT_COLUMN, HASH_KEYS, RAW_COLUMNS


def _ts_literal(value: _dt.datetime | str | None) -> Column:
    return F.current_timestamp() if value is None else F.lit(value).cast("timestamp")


def add_lineage(
    raw: DataFrame,
    ingested_at: _dt.datetime | str | None = None,
    source_file: str | None = None,
    version: str = BRONZE_VERSION,
    hash_keys=HASH_KEYS,
) -> DataFrame:
    """B1+B2: raw lines + ingestion_timestamp, source_file, bronze_layer_version,
    record_hash (12 columns; a reader's corrupt-record text is kept as a 13th).
    ``ingested_at`` fixes the load time (default: now), ``source_file`` names the
    source (default: the file each line was read from, or the reader's own
    ``source_file``)."""
    named = F.col("source_file") if "source_file" in raw.columns else F.input_file_name()
    corrupt = [CORRUPT_COLUMN] if CORRUPT_COLUMN in raw.columns else []
    return raw.select(
        *RAW_COLUMNS,
        _ts_literal(ingested_at).alias("ingestion_timestamp"),
        (named if source_file is None else F.lit(source_file)).alias("source_file"),
        F.lit(version).alias("bronze_layer_version"),
        record_hash(hash_keys).alias("record_hash"),
        *corrupt,
    )


def bronze_quality(bronze: DataFrame) -> DataFrame:
    """One row — total rows, NULL customers (+ %), negative quantities, and
    the lines the reader could not parse, if it kept them. One aggregate job
    instead of three counts."""
    corrupt = [F.count(CORRUPT_COLUMN).alias("corrupt_rows")] if CORRUPT_COLUMN in bronze.columns else []
    total = F.count(F.lit(1))
    nulls = F.count_if(F.col("CustomerID").isNull())
    return bronze.agg(
        total.alias("total_rows"),
        nulls.alias("null_customers"),
        F.round(F.try_divide(nulls * 100.0, total), 2).alias("null_customers_pct"),
        F.count_if(F.col("Quantity") < 0).alias("negative_quantities"),
        *corrupt,
    )


SAMPLE_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "UnitPrice", "Country",
    "ingestion_timestamp", "record_hash",
]


def bronze_sample(bronze: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows of the 8-column projection, in a fixed order
    (top-k: TakeOrderedAndProject, no global sort)."""
    return bronze.select(*SAMPLE_COLUMNS).orderBy(*SAMPLE_COLUMNS).limit(n)


def ingest_transactions(
    spark: SparkSession,
    path: str,
    base: str,
    fmt: str = "csv",
    table_fmt: str = "parquet",
    ingested_at: _dt.datetime | str | None = None,
    multi_line: bool = False,
) -> tuple[str, DataFrame]:
    """Read raw file (A2) -> lineage (B1/B2) -> write bronze/transactions
    (A4); returns its path and the quality row (B3) of what was stored."""
    raw = read_raw(spark, path, fmt=fmt, **({"multi_line": True} if multi_line else {}))
    stored = write_table(add_lineage(raw, ingested_at=ingested_at), base, "bronze", "transactions", fmt=table_fmt)
    return stored, bronze_quality(read_table(spark, base, "bronze", "transactions", fmt=table_fmt))
