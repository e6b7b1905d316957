"""Business marts (gold): D1-D26.

Shape of each mart at scale:

* lines are aggregated once per grain with map-side partial aggregation (hot
  customers/products/countries collapse before the shuffle);
* per-customer / per-product figures are rolled up from that (small) table
  instead of re-reading lines in sibling aggregates joined back together;
* scalars (last invoice date, total revenue, revenue quantiles) are 1-row
  aggregates cross-joined as broadcasts — no ``collect`` into the driver;
* RFM tiles use the distributed exact ``ntile`` of ``ranking.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import safe_div
from tillroll.operators.ranking import ntiles, quantiles
from tillroll.session import materialize
from tillroll.operators.silver import (
    _as_of_date,
    customer_profile_columns,
    product_catalog_columns,
    valid_sales,
)

# RFM segment rules (ordered, first match wins) and labels.
RFM_SEGMENTS = [
    ("Champions", lambda r, f: (r >= 4) & (f >= 4)),
    ("Loyal Customers", lambda r, f: (r >= 3) & (f >= 3)),
    ("Promising", lambda r, f: (r >= 4) & (f <= 2)),
    ("At Risk", lambda r, f: (r <= 2) & (f >= 4)),
    ("Hibernating", lambda r, f: (r <= 2) & (f <= 2)),
]
RFM_DEFAULT_SEGMENT = "Potential Loyalists"

# Product performance bands (percent of revenue ranks -> label).
PERFORMANCE_BANDS = [(80, "Star Products"), (50, "Good Performers"), (20, "Average")]
PERFORMANCE_DEFAULT = "Underperformers"


# ------------------------------------------------------------ customer grain

def customer_country_stats(clean: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One pass over valid known-customer lines per (CustomerID, Country), and per
    the further keys ``by`` (parts that ``plans.refresh`` merges).

    Holds the silver profile columns plus decomposable pieces (counts, sums,
    min/max) from which every per-customer gold figure is rolled up."""
    v = valid_sales(clean, known_customer=True)
    return v.groupBy("CustomerID", "Country", *by).agg(
        F.min("invoice_datetime").alias("first_purchase_date"),
        F.max("invoice_datetime").alias("last_purchase_date"),
        F.count("InvoiceNo").alias("total_transactions"),
        F.sum("total_price").alias("total_spent"),
        F.avg("total_price").alias("avg_transaction_value"),
        F.count("InvoiceNo").alias("unique_products_purchased"),
        F.count(F.lit(1)).alias("_rows"),
        F.count("total_price").alias("_n_price"),
        F.max("total_price").alias("_max_price"),
        F.min("total_price").alias("_min_price"),
        F.sum("Quantity").alias("_qty_sum"),
        F.count("Quantity").alias("_qty_n"),
        F.count("StockCode").alias("_n_stock"),
        F.count("Description").alias("_n_desc"),
        F.count_if(F.col("is_weekend")).alias("_weekend"),
        F.sum("hour").alias("_hour_sum"),
        F.count("hour").alias("_hour_n"),
    )


def customer_rollup(cc: DataFrame) -> DataFrame:
    """D3 (without recency) + D7 + D8 + D9 per CustomerID from the
    per-(CustomerID, Country) table."""
    rows = F.sum("_rows")
    spent = F.sum("total_spent")
    return cc.groupBy("CustomerID").agg(
        F.max("last_purchase_date").alias("_last_ts"),
        F.sum("total_transactions").alias("frequency"),
        spent.alias("monetary"),
        safe_div(spent, F.sum("_n_price")).alias("avg_order_value"),
        F.max("_max_price").alias("max_order_value"),
        F.min("_min_price").alias("min_order_value"),
        rows.alias("unique_invoices"),
        safe_div(spent, rows).alias("avg_basket_value"),
        safe_div(F.sum("_qty_sum"), F.sum("_qty_n")).alias("avg_items_per_transaction"),
        F.sum("_n_stock").alias("unique_products"),
        F.sum("_n_desc").alias("unique_categories"),
        safe_div(F.sum("_weekend"), rows).alias("weekend_purchase_ratio"),
        safe_div(F.sum("_hour_sum"), F.sum("_hour_n")).alias("avg_purchase_hour"),
    )


def with_recency(per_customer: DataFrame, last_col: str = "_last_ts") -> DataFrame:
    """D2+D3: recency_days = days from each customer's last purchase to the
    data's last purchase date. The global max is a 1-row aggregate over the
    per-customer table, broadcast back (no driver round trip; an empty input
    gives an empty result instead of an error)."""
    last = per_customer.agg(F.to_date(F.max(last_col)).alias("_tr_as_of"))
    return per_customer.crossJoin(F.broadcast(last)).withColumn(
        "recency_days", F.datediff(F.col("_tr_as_of"), F.col(last_col))
    ).drop("_tr_as_of")


def rfm_segment(r: Column, f: Column) -> Column:
    """Ordered rules on (r_score, f_score)."""
    expr = None
    for label, rule in RFM_SEGMENTS:
        expr = F.when(rule(r, f), label) if expr is None else expr.when(rule(r, f), label)
    return expr.otherwise(RFM_DEFAULT_SEGMENT)


def rfm_scores(
    per_customer: DataFrame, k: int = 5, num_partitions: int | None = None,
) -> DataFrame:
    """r = k+1 - ntile(recency asc), f = ntile(frequency asc),
    m = ntile(monetary asc); ties broken by CustomerID; rfm text; segment."""
    df = ntiles(per_customer, "CustomerID",
                {"_r_tile": "recency_days", "f_score": "frequency", "m_score": "monetary"},
                k, num_partitions=num_partitions)
    df = df.withColumn("r_score", (F.lit(k + 1) - F.col("_r_tile")).cast("int")).drop("_r_tile")
    return df.withColumn(
        "rfm_score", F.concat_ws("", "r_score", "f_score", "m_score")
    ).withColumn("customer_segment", rfm_segment(F.col("r_score"), F.col("f_score")))


RFM_COLUMNS = [
    "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score",
    "rfm_score", "customer_segment",
]
# Output column names and order of the marts.
BEHAVIOR_COLUMNS = [
    "avg_order_value", "max_order_value", "min_order_value", "unique_invoices",
    "avg_basket_value", "avg_items_per_transaction",
]
DIVERSITY_COLUMNS = ["unique_products", "unique_categories"]
TEMPORAL_COLUMNS = ["weekend_purchase_ratio", "avg_purchase_hour"]
PROFILE_COLUMNS = [
    "CustomerID", "Country", "first_purchase_date", "last_purchase_date",
    "total_transactions", "total_spent", "avg_transaction_value",
    "unique_products_purchased", "customer_lifetime_days", "days_since_last_purchase",
    "avg_days_between_purchases",
]
CUSTOMER_360_COLUMNS = (
    PROFILE_COLUMNS + RFM_COLUMNS + BEHAVIOR_COLUMNS + DIVERSITY_COLUMNS + TEMPORAL_COLUMNS
)


def rfm(clean: DataFrame) -> DataFrame:
    """D3: CustomerID, recency_days, frequency, monetary."""
    per = with_recency(customer_rollup(customer_country_stats(clean)))
    return per.select("CustomerID", "recency_days", "frequency", "monetary")


def rfm_table(clean: DataFrame, k: int = 5, num_partitions: int | None = None) -> DataFrame:
    """D3-D6 as one table per customer."""
    per = with_recency(customer_rollup(materialize(customer_country_stats(clean), "customer_country")))
    scored = rfm_scores(per.select("CustomerID", "recency_days", "frequency", "monetary"),
                        k=k, num_partitions=num_partitions)
    return scored.select("CustomerID", *RFM_COLUMNS)


def customer_360(clean: DataFrame | None, as_of=None, num_partitions: int | None = None,
                 cc: DataFrame | None = None) -> DataFrame:
    """Silver customers (grain CustomerID, Country) + RFM, behaviour,
    diversity, temporal figures per CustomerID (29 columns).

    Lines are aggregated once into the per-(CustomerID, Country) table, which
    is materialised (a table in the checkpoint directory: it is read by the profile side and by
    the per-customer rollup); the per-customer table is derived from it and
    joined back once (a multi-country customer gets the same figures on each
    of its rows, as in the reference). ``cc`` is a stored ``customer_country_stats``.
    The per-customer table is stored too: the ranking and the output read it."""
    if cc is None:
        cc = materialize(customer_country_stats(clean), "customer_country")
    per = materialize(with_recency(customer_rollup(cc)), "per_customer")
    per = rfm_scores(per, num_partitions=num_partitions)
    per = per.select("CustomerID", *(CUSTOMER_360_COLUMNS[len(PROFILE_COLUMNS):]))
    profile = customer_profile_columns(cc, as_of=as_of)
    return profile.join(per, "CustomerID", "left").select(*CUSTOMER_360_COLUMNS)


# Q1/Q2: the marts keep the reference's ``unique_*`` columns, which count rows
# (non-null values), not distinct values. The true distinct counts are a
# separate, opt-in table per grain: (key columns, known customers only,
# {output column: counted column}).
DISTINCT_SIBLINGS = {
    "customer": (["CustomerID"], True,
                 {"distinct_invoices": "InvoiceNo", "distinct_products": "StockCode",
                  "distinct_categories": "Description"}),
    "product": (["StockCode"], False,
                {"distinct_buyers": "CustomerID", "distinct_invoices": "InvoiceNo"}),
    "country": (["Country"], False,
                {"distinct_customers": "CustomerID", "distinct_products": "StockCode"}),
    "daily": (["date", "Country"], False,
              {"distinct_customers": "CustomerID", "distinct_products_sold": "StockCode"}),
}


def distinct_counts(clean: DataFrame, grain: str = "customer") -> DataFrame:
    """Exact distinct counts over valid lines for one mart grain (join it to
    the mart on the key columns when needed). Several distinct columns in one
    aggregate make Spark expand each line once per column, which is why this
    is not folded into the marts by default."""
    keys, known, cols = DISTINCT_SIBLINGS[grain]
    v = valid_sales(clean, known_customer=known)
    if "date" in keys:
        v = v.withColumn("date", F.to_date("invoice_datetime"))
    return v.groupBy(*keys).agg(*[F.count_distinct(c).alias(name) for name, c in cols.items()])


def segment_distribution(c360: DataFrame) -> DataFrame:
    """Customers per RFM segment with mean revenue / frequency."""
    return (
        c360.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.round(F.avg("monetary"), 2).alias("avg_revenue"),
            F.round(F.avg("frequency"), 2).alias("avg_frequency"),
        )
        .orderBy(F.col("count").desc(), "customer_segment")
    )


# ------------------------------------------------------------- product grain

def product_line_stats(clean: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One pass over valid lines per (StockCode, Description) and ``by``: silver catalog
    columns + pieces for the per-StockCode rollups (performance, popularity):
    counts, sums and the within-group second moment of UnitPrice."""
    v = valid_sales(clean)
    n_unit = F.count("UnitPrice")
    return v.groupBy("StockCode", "Description", *by).agg(
        F.count("InvoiceNo").alias("times_purchased"),
        F.sum("Quantity").alias("total_quantity_sold"),
        F.avg("UnitPrice").alias("avg_price"),
        F.min("UnitPrice").alias("min_price"),
        F.max("UnitPrice").alias("max_price"),
        F.sum("total_price").alias("total_revenue"),
        F.count(F.lit(1)).alias("unique_customers"),
        F.count("total_price").alias("_n_price"),
        n_unit.alias("_n_unit"),
        (F.var_pop("UnitPrice") * n_unit).alias("_m2_unit"),
    )


def materialized_product_stats(clean: DataFrame) -> DataFrame:
    """``product_line_stats`` stored once (it feeds the catalog columns, the
    per-StockCode rollups and the quantile aggregate)."""
    return materialize(product_line_stats(clean), "product_lines")


def product_performance(pls: DataFrame) -> DataFrame:
    """D12 per StockCode, rolled up from the (StockCode, Description) table."""
    revenue = F.sum("total_revenue")
    return pls.groupBy("StockCode").agg(
        revenue.alias("total_revenue_gold"),
        F.sum("total_quantity_sold").alias("total_quantity_gold"),
        F.sum("unique_customers").alias("unique_buyers"),
        safe_div(revenue, F.sum("_n_price")).alias("avg_transaction_value"),
        F.sum("times_purchased").alias("purchase_frequency"),
    )


def performance_category(df: DataFrame, col: str = "total_revenue",
                         keys=("StockCode", "Description")) -> DataFrame:
    """Bands by the exact 20/50/80 % lower quantiles of ``col``, taken from
    the distributed ranking of the narrow (col, keys) rows and broadcast back as
    one row."""
    q = quantiles(df, col, keys, [p for p, _ in PERFORMANCE_BANDS])
    out = df.crossJoin(F.broadcast(q))
    expr = None
    for i, (_, label) in enumerate(PERFORMANCE_BANDS):
        cond = F.col(col) >= F.col("_tr_q")[i]
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return out.withColumn("performance_category", expr.otherwise(PERFORMANCE_DEFAULT)).drop("_tr_q")


PRODUCT_METRICS_COLUMNS = [
    "StockCode", "Description", "times_purchased", "avg_price", "min_price", "max_price",
    "unique_customers", "avg_quantity_per_order", "revenue_per_customer", "total_revenue",
    "total_quantity_sold", "unique_buyers", "avg_transaction_value", "purchase_frequency",
    "performance_category",
]


def product_metrics(clean: DataFrame | None, pls: DataFrame | None = None) -> DataFrame:
    """Silver products (grain StockCode, Description) with the two
    revenue/quantity columns replaced by per-StockCode totals (D13), buyers,
    frequency and the performance band (15 columns). Lines are read once
    (``pls``: a stored ``product_line_stats``)."""
    if pls is None:
        pls = materialized_product_stats(clean)
    catalog = product_catalog_columns(pls).drop("total_revenue", "total_quantity_sold")
    perf = product_performance(pls)
    joined = replace_columns_join(
        catalog, perf, "StockCode",
        {"total_revenue_gold": "total_revenue", "total_quantity_gold": "total_quantity_sold"},
    )
    # stored once: the quantiles and the bands read it
    return performance_category(materialize(joined, "product_metrics")).select(*PRODUCT_METRICS_COLUMNS)


def replace_columns_join(left: DataFrame, right: DataFrame, key: str,
                         renames: dict[str, str]) -> DataFrame:
    """Drop the replaced columns from ``left``, left-join ``right`` on
    ``key``, rename ``right``'s columns to the replaced names."""
    out = left.drop(*renames.values()).join(right, key, "left")
    for src, dst in renames.items():
        out = out.withColumnRenamed(src, dst)
    return out


def top_products(pm: DataFrame, n: int = 10) -> DataFrame:
    """6-column projection by revenue, top ``n``."""
    return (
        pm.select("StockCode", "Description", "total_revenue", "total_quantity_sold",
                  "unique_buyers", "performance_category")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "StockCode", "Description")
        .limit(n)
    )


# ---------------------------------------------------------------- daily grain

DAILY_COLUMNS = [
    "date", "Country", "total_transactions", "unique_customers", "total_revenue",
    "avg_transaction_value", "total_items_sold", "unique_products_sold", "year", "month",
    "quarter", "day_of_week", "revenue_ma_7d", "revenue_ma_30d", "transactions_ma_7d",
]


def daily_sales(clean: DataFrame) -> DataFrame:
    """Per (date, Country) over valid lines."""
    v = valid_sales(clean)
    return v.groupBy(F.to_date("invoice_datetime").alias("date"), "Country").agg(
        F.count("InvoiceNo").alias("total_transactions"),
        F.count(F.lit(1)).alias("unique_customers"),
        F.sum("total_price").alias("total_revenue"),
        F.avg("total_price").alias("avg_transaction_value"),
        F.sum("Quantity").alias("total_items_sold"),
        F.count("StockCode").alias("unique_products_sold"),
        F.count("total_price").alias("_n_price"),
    )


def daily_calendar(daily: DataFrame) -> DataFrame:
    """Year, month, quarter and day_of_week (the week-start timestamp,
    as in the reference)."""
    return daily.select(
        "*",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        F.date_trunc("week", F.col("date")).alias("day_of_week"),
    )


def moving_averages(daily: DataFrame) -> DataFrame:
    """Per Country by date, mean revenue over the last 7 and 30 rows and
    mean transactions over the last 7 rows (ROWS frames: missing dates are not
    filled). The windows run on the daily table, so a country holds one row
    per day — no skewed sort of lines."""
    by_country = Window.partitionBy("Country").orderBy("date")
    w7 = by_country.rowsBetween(-6, 0)
    w30 = by_country.rowsBetween(-29, 0)
    return daily.select(
        "*",
        F.avg("total_revenue").over(w7).alias("revenue_ma_7d"),
        F.avg("total_revenue").over(w30).alias("revenue_ma_30d"),
        F.avg("total_transactions").over(w7).alias("transactions_ma_7d"),
    )


def daily_aggregates(clean: DataFrame) -> DataFrame:
    """Daily sales (D17) + calendar (D18) + moving averages (D19), 15 columns."""
    return daily_mart(daily_sales(clean))


def daily_mart(daily: DataFrame) -> DataFrame:
    """D18 + D19 over a stored ``daily_sales``."""
    return moving_averages(daily_calendar(daily)).select(*DAILY_COLUMNS)


def recent_days(daily: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` daily rows."""
    return daily.orderBy(F.col("date").desc(), "Country").limit(n)


# -------------------------------------------------------------- country grain

def country_sales(clean: DataFrame) -> DataFrame:
    """Per Country over valid lines."""
    v = valid_sales(clean)
    return v.groupBy("Country").agg(
        F.count(F.lit(1)).alias("unique_customers"),
        F.count("InvoiceNo").alias("total_transactions"),
        F.sum("total_price").alias("total_revenue"),
        F.avg("total_price").alias("avg_order_value"),
        F.sum("Quantity").alias("total_items_sold"),
        F.count("StockCode").alias("unique_products"),
    )


def country_analytics(clean: DataFrame) -> DataFrame:
    """Revenue share (%) of the grand total and revenue per
    customer row, both rounded to 2 places (9 columns)."""
    return country_mart(country_sales(clean))


def country_mart(cs: DataFrame) -> DataFrame:
    """D23-D25 over ``country_sales``."""
    total = cs.agg(F.sum("total_revenue").alias("_tr_total"))
    return (
        cs.crossJoin(F.broadcast(total))
        .withColumn(
            "revenue_share",
            F.round(F.try_divide(F.col("total_revenue"), F.col("_tr_total")) * 100, 2),
        )
        .withColumn(
            "revenue_per_customer",
            F.round(F.try_divide(F.col("total_revenue"), F.col("unique_customers")), 2),
        )
        .drop("_tr_total")
    )


def top_countries(ca: DataFrame, n: int = 10) -> DataFrame:
    """Countries by revenue, top ``n``."""
    return ca.orderBy(F.col("total_revenue").desc_nulls_last(), "Country").limit(n)


def as_of_date(as_of) -> Column:
    return _as_of_date(as_of)
