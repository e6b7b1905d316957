"""Declared schemas (A1) and the fixed names shared by every layer."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# The raw invoice-line schema, in source order.
RAW_SCHEMA = StructType(
    [
        StructField("InvoiceNo", StringType(), True),
        StructField("StockCode", StringType(), True),
        StructField("Description", StringType(), True),
        StructField("Quantity", IntegerType(), True),
        StructField("InvoiceDate", StringType(), True),
        StructField("UnitPrice", DoubleType(), True),
        StructField("CustomerID", StringType(), True),
        StructField("Country", StringType(), True),
    ]
)

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
# Text of an input line that does not fit the schema (NULL for all others).
CORRUPT_COLUMN = "_corrupt_record"

# Invoice text format, lineage literals and the raw-record hash keys.
INVOICE_TS_FORMAT = "M/d/yyyy H:mm"
BRONZE_VERSION = "v1.0"
HASH_KEYS = ("InvoiceNo", "StockCode", "InvoiceDate")
HASH_SEPARATOR = "|"
UNKNOWN_DESCRIPTION = "UNKNOWN"

# Layer/table names used by the batch chain.
TABLES = {
    "bronze": ["transactions"],
    "silver": ["transactions_clean", "customers", "products"],
    "gold": [
        "customer_360",
        "product_metrics",
        "daily_aggregates",
        "country_analytics",
        "customer_segments",
    ],
    "feature_store": ["customer_features", "product_features", "transaction_features"],
}

# Tables written hive-partitioned (A5).
PARTITIONED_BY = {
    ("gold", "daily_aggregates"): ("year", "month"),
    ("feature_store", "transaction_features"): ("year", "month"),
}
