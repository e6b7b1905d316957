"""Column expressions shared by the operators (all JVM-side built-ins).

Spark 4 runs with ANSI semantics: plain casts, text-to-timestamp parsing and
division by zero raise instead of returning NULL. Every expression that can
meet bad input uses the ``try_*`` variant so that a bad row becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from tillroll.sources.schema import (
    HASH_KEYS,
    HASH_SEPARATOR,
    INVOICE_TS_FORMAT,
    UNKNOWN_DESCRIPTION,
)


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_invoice_ts(c: str | Column, dtype: DataType | None = None) -> Column:
    """``M/d/yyyy H:mm`` text -> timestamp; NULL on bad text, never raises.
    A column that already holds timestamps passes through."""
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return col_or(c).cast("timestamp")
    return F.try_to_timestamp(col_or(c).cast("string"), F.lit(INVOICE_TS_FORMAT))


def normalize_stock_code(c: str | Column = "StockCode") -> Column:
    """trim(upper(code))."""
    return F.trim(F.upper(col_or(c)))


def normalize_country(c: str | Column = "Country") -> Column:
    """trim(country)."""
    return F.trim(col_or(c))


def default_description(c: str | Column = "Description") -> Column:
    """C4: NULL -> 'UNKNOWN', otherwise trimmed."""
    return F.coalesce(F.trim(col_or(c)), F.lit(UNKNOWN_DESCRIPTION))


def customer_to_int(c: str | Column = "CustomerID") -> Column:
    """Customer id -> int; NULL/NaN/non-numeric text -> NULL (a guest).

    Going through double accepts '17850.0'; NaN is mapped to NULL explicitly so
    a guest never becomes customer 0."""
    as_double = col_or(c).cast("string").try_cast("double")
    return F.when(F.isnan(as_double), F.lit(None).cast("int")).otherwise(as_double.try_cast("int"))


def line_amount(qty: str | Column = "Quantity", price: str | Column = "UnitPrice") -> Column:
    """Quantity x UnitPrice as double."""
    return col_or(qty).cast("double") * col_or(price)


def flag_return(qty: str | Column = "Quantity") -> Column:
    """Negative quantity; NULL -> false."""
    return F.coalesce(col_or(qty) < 0, F.lit(False))


def flag_cancellation(invoice: str | Column = "InvoiceNo") -> Column:
    """Invoice number starting with 'C'; NULL -> false."""
    return F.coalesce(col_or(invoice).startswith("C"), F.lit(False))


def flag_weekend(dow: str | Column = "day_of_week") -> Column:
    """C11: Spark day_of_week 1 (Sunday) or 7 (Saturday)."""
    return F.coalesce(col_or(dow).isin(1, 7), F.lit(False))


def record_hash(cols=HASH_KEYS) -> Column:
    """B2: SHA-256 hex of the key columns joined by '|' (NULL parts skipped)."""
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.col(c).cast("string") for c in cols]), 256)


def safe_div(num: str | Column, den: str | Column) -> Column:
    """NULL when the denominator is 0 or NULL (ANSI-safe ``/``)."""
    return F.try_divide(col_or(num).cast("double"), col_or(den))


def ratio_or_zero(num: str | Column, den: str | Column) -> Column:
    """``num / den`` when ``den > 0``, else 0.0 (the feature-table guard)."""
    d = col_or(den)
    return F.when(d > 0, F.try_divide(col_or(num).cast("double"), d)).otherwise(F.lit(0.0))
