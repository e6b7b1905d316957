"""Column-level building blocks (no DataFrames here)."""

from tillroll.functions.columns import (
    customer_to_int,
    default_description,
    flag_cancellation,
    flag_return,
    flag_weekend,
    line_amount,
    normalize_country,
    normalize_stock_code,
    parse_invoice_ts,
    ratio_or_zero,
    record_hash,
    safe_div,
)

__all__ = [
    "customer_to_int",
    "default_description",
    "flag_cancellation",
    "flag_return",
    "flag_weekend",
    "line_amount",
    "normalize_country",
    "normalize_stock_code",
    "parse_invoice_ts",
    "ratio_or_zero",
    "record_hash",
    "safe_div",
]
