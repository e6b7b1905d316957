"""Schemas, readers/writers and the driver-table adapter."""

from tillroll.sources.io import (
    conform_raw,
    read_csv,
    read_raw,
    read_table,
    rows_source,
    write_csv,
    write_partitioned,
    write_table,
)
from tillroll.sources.schema import RAW_COLUMNS, RAW_SCHEMA
from tillroll.sources.tables import DRIVER_TABLES, load, raw_invoice_lines

__all__ = [
    "DRIVER_TABLES",
    "RAW_COLUMNS",
    "RAW_SCHEMA",
    "conform_raw",
    "load",
    "raw_invoice_lines",
    "read_csv",
    "read_raw",
    "read_table",
    "rows_source",
    "write_csv",
    "write_partitioned",
    "write_table",
]
