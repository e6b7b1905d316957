"""Cleaning and dimensions (silver): C1-C22.

``clean_transactions`` is one narrow projection plus one keyed de-duplication;
the dimensions are single hash aggregates. The customer and product dimensions
share their aggregation with the gold marts (see ``gold.customer_country_stats``
and ``gold.product_line_stats``), so a mart never re-reads lines for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.session import materialize
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
    record_hash,
    safe_div,
)
from tillroll.sources.schema import HASH_KEYS

BRONZE_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
    "CustomerID", "Country", "ingestion_timestamp", "source_file",
    "bronze_layer_version", "record_hash",
]

DERIVED_COLUMNS = [
    "invoice_datetime", "total_price", "is_return", "is_cancellation", "year", "month",
    "day", "day_of_week", "hour", "quarter", "is_weekend",
]

SILVER_COLUMNS = BRONZE_COLUMNS + DERIVED_COLUMNS

# Deterministic survivor among rows sharing a record hash: newest load first,
# then the row content (any survivor is legal; this one is repeatable).
DEDUP_TIEBREAK = ("Quantity", "UnitPrice", "Description", "CustomerID", "Country")


def parse_and_validate(bronze: DataFrame, keep: Sequence[Column] = ()) -> DataFrame:
    """Parse the timestamp, drop unusable rows, normalise text and ids; further
    columns to ``keep``, of the raw line, come last."""
    ts = parse_invoice_ts("InvoiceDate", bronze.schema["InvoiceDate"].dataType)
    replaced = {
        "StockCode": normalize_stock_code("StockCode"),
        "Country": normalize_country("Country"),
        "Description": default_description("Description"),
        "CustomerID": customer_to_int("CustomerID"),
    }
    cols: list[Column] = [
        replaced[c].alias(c) if c in replaced else F.col(c) for c in BRONZE_COLUMNS
    ]
    return bronze.select(*cols, ts.alias("invoice_datetime"), *keep).where(
        F.col("invoice_datetime").isNotNull()
        & F.col("Quantity").isNotNull()
        & F.col("UnitPrice").isNotNull()
        & (F.col("UnitPrice") >= 0)
    )


def enrich(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Amount, return/cancel flags, calendar parts, weekend flag; further
    columns to ``keep`` come last."""
    ts = F.col("invoice_datetime")
    dow = F.dayofweek(ts)
    return df.select(
        *BRONZE_COLUMNS,
        "invoice_datetime",
        line_amount().alias("total_price"),
        flag_return().alias("is_return"),
        flag_cancellation().alias("is_cancellation"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        dow.alias("day_of_week"),
        F.hour(ts).alias("hour"),
        F.quarter(ts).alias("quarter"),
        flag_weekend(dow).alias("is_weekend"),
        *keep,
    )


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str] = ("record_hash",),
    newest: str = "ingestion_timestamp",
    tiebreak: Sequence[str] = DEDUP_TIEBREAK,
) -> DataFrame:
    """Keep one row per key — the newest load, ties broken by content.

    Planned as a per-key top-1 (``WindowGroupLimit``): a partial top-1 runs
    before the shuffle, so a key repeated in many input rows ships one row per
    map task, not all of them."""
    order = [F.col(newest).desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_tr_rn", F.row_number().over(w))
        .where(F.col("_tr_rn") == 1)
        .drop("_tr_rn")
    )


def packed_hash(c: str = "record_hash") -> Column:
    """A hex hash as byte 1 and its 32 bytes, any other text as byte 0 and its bytes:
    equal where the texts are."""
    text = F.col(c)
    return F.when(text.rlike(r"\A[0-9a-f]{64}\z"), F.concat(F.unhex(F.lit("01")), F.unhex(text))).otherwise(
        F.concat(F.unhex(F.lit("00")), text.cast("binary")))


def unpacked_hash(c: str = "record_hash") -> Column:
    """The text that ``packed_hash`` packed."""
    packed = F.col(c)
    rest = F.expr(f"substring({c}, 2)")
    return F.when(F.substring(packed, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


#: the stock code as it came, of which the record hash is made
RAW_CODE = "_tr_raw_code"
_OWN_KEYS = [RAW_CODE if c == "StockCode" else c for c in HASH_KEYS]


def raw_code_column() -> Column:
    return F.col("StockCode").alias(RAW_CODE)


def own_hash() -> Column:
    """The record hash of a line's own columns (``RAW_CODE`` stands for the stock code)."""
    return record_hash(_OWN_KEYS)


def spared_hash() -> Column:
    """``packed_hash``, or no byte where it is the line's ``own_hash``."""
    return F.when(F.col("record_hash") == own_hash(), F.unhex(F.lit(""))).otherwise(packed_hash())


def restored_hash() -> Column:
    """The text that ``spared_hash`` spared or packed."""
    return F.when(F.octet_length("record_hash") == 0, own_hash()).otherwise(unpacked_hash())


def clean_transactions(
    bronze: DataFrame, keys: Sequence[str] = ("record_hash",)
) -> DataFrame:
    """Bronze (12 columns) -> transactions_clean (23 columns).

    The derived columns are per-row functions, so they are computed after the
    de-duplication: the shuffle and sort carry 13 columns instead of 23, and the
    record hash as its bytes (``packed_hash``)."""
    lines = parse_and_validate(bronze)
    packed = lines.withColumn("record_hash", packed_hash())
    return enrich(dedupe_latest(packed, keys=keys).withColumn("record_hash", unpacked_hash())).select(*SILVER_COLUMNS)


def short_hash(c: str = "record_hash") -> Column:
    """Half of a hex hash, as byte 1 and its first 16 bytes; of any other text as much
    as ``packed_hash`` keeps. Two of a million million hashes share a half with odds of
    1 in 10^14."""
    packed = packed_hash(c)
    return F.when(F.substring(packed, 1, 1) == F.unhex(F.lit("01")), F.substring(packed, 1, 17)).otherwise(packed)


def lean_clean(bronze: DataFrame, keys: Sequence[str] = ("record_hash",)) -> DataFrame:
    """``clean_transactions`` for readers that only count invoice numbers and ask
    whether they cancel: the same lines, the de-duplication carrying a mark in
    place of the number and half of each record hash."""
    number = F.col("InvoiceNo")
    mark = F.when(number.isNotNull(), F.when(flag_cancellation(), F.lit("C")).otherwise(F.lit("")))
    lean = parse_and_validate(bronze).withColumns({"record_hash": short_hash(), "InvoiceNo": mark})
    return enrich(dedupe_latest(lean, keys=keys)).select(*SILVER_COLUMNS)


#: so many hashes at most are sent to every task
FEW_REPEATED = 1_000_000


def split_repeated(lines: DataFrame, few: int = FEW_REPEATED) -> tuple[DataFrame | None, DataFrame]:
    """Lines without copies, and those that may be copies: of all columns only 6 bytes
    of the hash are shuffled to find which repeat. Where more than ``few`` do, there are
    no lines of the first kind. ``lines`` is read three times."""
    short = F.shiftrightunsigned(F.xxhash64("record_hash"), 16)  # of equal hashes equal; if others meet, they are only looked at
    repeated = materialize(
        lines.groupBy(short.alias("_tr_short")).agg(F.count(F.lit(1)).alias("_tr_n")).where("_tr_n > 1").select("_tr_short"), "repeated")
    if repeated.count() > few:
        return None, lines
    found, same = F.broadcast(repeated), short == F.col("_tr_short")
    return lines.join(found, same, "left_anti"), lines.join(found, same, "left_semi")


def stored_clean(bronze: DataFrame, few: int = FEW_REPEATED, raw_code: bool = False) -> DataFrame:
    """C13 for readers that read it more than once: the parsed lines are stored, without
    the hashes that their columns give again (``spared_hash``). Only lines that may be
    copies (``split_repeated``) are de-duplicated, the others have none; where more than
    ``few`` hashes repeat, all lines are, and stored anew. With ``raw_code`` the column
    ``RAW_CODE`` comes last."""
    def restored(stored: DataFrame) -> DataFrame:
        return stored.withColumns({"record_hash": restored_hash(), "StockCode": normalize_stock_code(RAW_CODE)})

    def spared(lines: DataFrame) -> DataFrame:
        return lines.withColumn("record_hash", spared_hash()).drop("StockCode")

    def newest(lines: DataFrame) -> DataFrame:
        packed = dedupe_latest(lines.withColumn("record_hash", packed_hash()))
        return packed.withColumn("record_hash", unpacked_hash())

    parsed = parse_and_validate(bronze, [raw_code_column()])
    lines = restored(materialize(spared(parsed), "parsed"))
    single, repeated = split_repeated(lines, few)
    kept = restored(materialize(spared(newest(repeated)), "kept"))
    kept = kept if single is None else single.unionByName(kept)
    return enrich(kept, [RAW_CODE] if raw_code else ())


# ---------------------------------------------------------------- dimensions

def valid_sales(clean: DataFrame, known_customer: bool = False) -> DataFrame:
    """D1 (shared with gold): not a return, not a cancellation (and a known customer)."""
    cond = ~F.col("is_return") & ~F.col("is_cancellation")
    if known_customer:
        cond = F.col("CustomerID").isNotNull() & cond
    return clean.where(cond)


def _as_of_date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)).cast("date")


def customer_profile_columns(stats: DataFrame, as_of=None) -> DataFrame:
    """C15 over per-(CustomerID, Country) aggregates: lifetime, days since last
    purchase (relative to ``as_of``), lifetime / transactions."""
    lifetime = F.datediff("last_purchase_date", "first_purchase_date")
    return stats.select(
        "CustomerID",
        "Country",
        "first_purchase_date",
        "last_purchase_date",
        "total_transactions",
        "total_spent",
        "avg_transaction_value",
        "unique_products_purchased",
        lifetime.alias("customer_lifetime_days"),
        F.datediff(_as_of_date(as_of), F.col("last_purchase_date")).alias("days_since_last_purchase"),
        safe_div(lifetime, F.col("total_transactions")).alias("avg_days_between_purchases"),
    )


def customer_profiles(clean: DataFrame, as_of=None) -> DataFrame:
    """C14+C15: silver/customers, grain (CustomerID, Country), 11 columns."""
    from tillroll.operators.gold import customer_country_stats

    return customer_profile_columns(customer_country_stats(clean), as_of=as_of)


def product_catalog_columns(stats: DataFrame) -> DataFrame:
    """C17 over per-(StockCode, Description) aggregates."""
    return stats.select(
        "StockCode",
        "Description",
        "times_purchased",
        "total_quantity_sold",
        "avg_price",
        "min_price",
        "max_price",
        "total_revenue",
        "unique_customers",
        safe_div("total_quantity_sold", "times_purchased").alias("avg_quantity_per_order"),
        safe_div("total_revenue", "unique_customers").alias("revenue_per_customer"),
    )


def product_catalog(clean: DataFrame) -> DataFrame:
    """C16+C17: silver/products, grain (StockCode, Description), 11 columns."""
    from tillroll.operators.gold import product_line_stats

    return product_catalog_columns(product_line_stats(clean))


# ---------------------------------------------------------------- checks

def silver_quality(clean: DataFrame) -> DataFrame:
    """Totals of returns, cancellations, known customers with % (one job)."""
    total = F.count(F.lit(1))

    def pct(c: Column) -> Column:
        return F.round(F.try_divide(c * 100.0, total), 2)

    returns = F.count_if(F.col("is_return"))
    cancels = F.count_if(F.col("is_cancellation"))
    known = F.count_if(F.col("CustomerID").isNotNull())
    return clean.agg(
        total.alias("total_records"),
        returns.alias("returns"),
        pct(returns).alias("returns_pct"),
        cancels.alias("cancellations"),
        pct(cancels).alias("cancellations_pct"),
        known.alias("valid_customers"),
        pct(known).alias("valid_customers_pct"),
    )


def silver_date_range(clean: DataFrame) -> DataFrame:
    """First and last invoice timestamp."""
    return clean.agg(
        F.min("invoice_datetime").alias("min_date"),
        F.max("invoice_datetime").alias("max_date"),
    )


def silver_price_stats(clean: DataFrame) -> DataFrame:
    """C20: min / avg / max line amount over non-returns."""
    return clean.where(~F.col("is_return")).agg(
        F.min("total_price").alias("min_total_price"),
        F.avg("total_price").alias("avg_total_price"),
        F.max("total_price").alias("max_total_price"),
    )


def catalog_top_products(catalog: DataFrame, n: int = 10) -> DataFrame:
    """Catalog rows by revenue, top ``n`` (unique tie-break)."""
    return catalog.orderBy(
        F.col("total_revenue").desc_nulls_last(), "StockCode", "Description"
    ).limit(n)


def customer_sample(profiles: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` customer profiles in key order."""
    return profiles.orderBy("CustomerID", "Country").limit(n)
