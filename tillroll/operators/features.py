"""Feature tables: E1-E27.

* Customer features: one aggregate per CustomerID for behaviour, spending,
  affinity and engagement (E1, E4, E6, E7), and the purchase-gap statistics
  (E2/E3) from a per-(CustomerID, day) pre-aggregate: the gaps between a
  customer's time-ordered lines are zeros for repeated days plus the gaps
  between distinct days, so a hot customer is a few thousand day rows, never
  one task sorting all of its lines. One left join onto customer_360.
* Product features: product_metrics + per-StockCode popularity, both rolled
  up from one stored per-(StockCode, Description) aggregate of the lines.
* Transaction features: per-customer price/quantity statistics as a window over
  lines dealt by customer once; guest lines (NULL customer, no statistics) are
  salted over many keys so they cannot form one hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillroll.functions.columns import flag_weekend, line_amount, normalize_stock_code, ratio_or_zero, safe_div
from tillroll.operators.gold import (
    CUSTOMER_360_COLUMNS,
    as_of_date,
    customer_360,
    materialized_product_stats,
    product_metrics,
)
from tillroll.session import materialize
from tillroll.operators.silver import (
    RAW_CODE,
    SILVER_COLUMNS,
    enrich,
    packed_hash,
    restored_hash,
    spared_hash,
    unpacked_hash,
    valid_sales,
)

# Output column names and order of the feature tables.
BEHAVIOR_FE = [
    "purchase_frequency_fe", "avg_transaction_value_fe", "std_transaction_value",
    "max_transaction_value_fe", "min_transaction_value_fe", "avg_items_per_order_fe",
    "max_items_per_order", "total_products_purchased", "unique_products_fe",
    "weekend_purchase_ratio_fe", "avg_purchase_hour_fe", "std_purchase_hour",
]
GAP_FE = [
    "avg_days_between_purchases_fe", "std_days_between_purchases",
    "min_days_between_purchases", "max_days_between_purchases",
]
SPENDING_FE = [
    "total_lifetime_value_fe", "avg_basket_value_fe", "spending_last_30_days",
    "spending_last_90_days", "spending_trend_30_vs_90",
]
AFFINITY_FE = ["product_variety", "unique_stock_codes"]
ENGAGEMENT_FE = [
    "total_invoices_fe", "recency_days_fe", "customer_age_days_fe", "engagement_score_fe",
]
DERIVED_FE = [
    "clv_to_frequency_ratio", "recency_to_age_ratio", "log_monetary", "sqrt_frequency",
    "purchase_regularity", "spending_consistency",
]
CUSTOMER_FEATURE_COLUMNS = (
    CUSTOMER_360_COLUMNS + BEHAVIOR_FE + GAP_FE + SPENDING_FE + AFFINITY_FE + ENGAGEMENT_FE
    + DERIVED_FE
)


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """NULL -> 0 in numeric columns only (text, bool, timestamps kept)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=numeric) if numeric else df


def customer_line_features(valid_known: DataFrame, as_of=None) -> DataFrame:
    """E1 + E4/E5 + E6 + E7/E8 per CustomerID (known customers only)."""
    asof = as_of_date(as_of)
    ts = F.col("invoice_datetime")
    price = F.col("total_price")
    spent = F.sum(price)
    n_inv = F.count("InvoiceNo")
    age = F.datediff(F.max(ts), F.min(ts))
    agg = valid_known.groupBy("CustomerID").agg(
        n_inv.alias("purchase_frequency_fe"),
        F.avg(price).alias("avg_transaction_value_fe"),
        F.stddev(price).alias("std_transaction_value"),
        F.max(price).alias("max_transaction_value_fe"),
        F.min(price).alias("min_transaction_value_fe"),
        F.avg("Quantity").alias("avg_items_per_order_fe"),
        F.max("Quantity").alias("max_items_per_order"),
        F.count("StockCode").alias("total_products_purchased"),
        F.count("StockCode").cast("int").alias("unique_products_fe"),
        F.avg(F.when(F.col("is_weekend"), 1).otherwise(0)).alias("weekend_purchase_ratio_fe"),
        F.avg("hour").alias("avg_purchase_hour_fe"),
        F.stddev("hour").alias("std_purchase_hour"),
        spent.alias("total_lifetime_value_fe"),
        safe_div(spent, n_inv).alias("avg_basket_value_fe"),
        F.sum(F.when(F.datediff(asof, ts) <= 30, price).otherwise(0)).alias("spending_last_30_days"),
        F.sum(F.when(F.datediff(asof, ts) <= 90, price).otherwise(0)).alias("spending_last_90_days"),
        F.count("StockCode").alias("product_variety"),
        n_inv.alias("total_invoices_fe"),
        F.datediff(asof, F.max(ts)).alias("recency_days_fe"),
        age.alias("customer_age_days_fe"),
    )
    # counted apart: beside the other aggregates, Spark would ship all their buffers
    # once per (customer, product)
    codes = valid_known.groupBy("CustomerID").agg(F.count_distinct("StockCode").cast("int").alias("unique_stock_codes"))
    return agg.join(codes.hint("merge"), "CustomerID").withColumn("spending_trend_30_vs_90", spending_trend()).withColumn(
        "engagement_score_fe", engagement_score()
    )


def spending_trend(last30: str = "spending_last_30_days", last90: str = "spending_last_90_days"):
    """E5: 30-day / 90-day spend, 0 when the 90-day spend is not positive."""
    return ratio_or_zero(last30, last90)


def engagement_score(invoices: str = "total_invoices_fe", age: str = "customer_age_days_fe"):
    """Lines per 30 days of customer age, 0 for a zero age."""
    return F.when(F.col(age) > 0, F.col(invoices) / (F.col(age) / 30)).otherwise(F.lit(0.0))


def purchase_gap_features(valid_known: DataFrame) -> DataFrame:
    """E2+E3: avg / stddev / min / max of the day gaps between a customer's
    consecutive lines (ordered by time), computed from one row per
    (customer, day): with n lines on m distinct days the n-1 gaps are n-m
    zeros plus the m-1 gaps between consecutive days."""
    daily = valid_known.groupBy(
        "CustomerID", F.to_date("invoice_datetime").alias("_day")
    ).agg(F.count(F.lit(1)).alias("_lines"))
    w = Window.partitionBy("CustomerID").orderBy("_day")
    gaps = daily.withColumn("_gap", F.datediff("_day", F.lag("_day").over(w)))
    s = gaps.groupBy("CustomerID").agg(
        F.sum("_lines").alias("_n"),
        F.count(F.lit(1)).alias("_m"),
        F.coalesce(F.sum("_gap"), F.lit(0)).alias("_sg"),
        F.coalesce(F.sum(F.col("_gap").cast("long") * F.col("_gap")), F.lit(0)).alias("_sg2"),
        F.min("_gap").alias("_gmin"),
        F.max("_gap").alias("_gmax"),
    )
    n_gaps = F.col("_n") - 1
    dec = "decimal(38,0)"
    # sample variance from exact integer sums: (N*S2 - S^2) / (N*(N-1))
    num = n_gaps.cast(dec) * F.col("_sg2").cast(dec) - F.col("_sg").cast(dec) * F.col("_sg").cast(dec)
    den = n_gaps.cast(dec) * (n_gaps - 1).cast(dec)
    # NULL below two gaps, as a sample standard deviation is
    std = F.when(n_gaps > 1, F.sqrt(F.greatest(num.cast("double") / den.cast("double"), F.lit(0.0))))
    has_zero = F.col("_n") > F.col("_m")
    return s.select(
        "CustomerID",
        F.when(n_gaps > 0, F.col("_sg") / n_gaps).alias("avg_days_between_purchases_fe"),
        std.alias("std_days_between_purchases"),
        F.when(n_gaps > 0, F.when(has_zero, F.lit(0)).otherwise(F.col("_gmin")))
        .cast("int").alias("min_days_between_purchases"),
        F.when(n_gaps > 0, F.coalesce(F.col("_gmax"), F.lit(0)))
        .cast("int").alias("max_days_between_purchases"),
    )


def derived_ratios(df: DataFrame) -> DataFrame:
    """Guarded ratios, log / sqrt transforms."""
    return df.select(
        "*",
        ratio_or_zero("monetary", "frequency").alias("clv_to_frequency_ratio"),
        ratio_or_zero("recency_days", "customer_age_days_fe").alias("recency_to_age_ratio"),
        F.log(F.col("monetary") + 1).alias("log_monetary"),
        F.sqrt(F.col("frequency")).alias("sqrt_frequency"),
        ratio_or_zero("avg_days_between_purchases_fe", "std_days_between_purchases")
        .alias("purchase_regularity"),
        ratio_or_zero("std_transaction_value", "avg_transaction_value_fe")
        .alias("spending_consistency"),
    )


#: what the customer marts read of a line
CUSTOMER_LINE_COLUMNS = [
    "CustomerID", "Country", "InvoiceNo", "StockCode", "Description", "Quantity", "invoice_datetime", "total_price",
]


def customer_lines(clean: DataFrame) -> DataFrame:
    """The lines and columns that ``customer_features`` reads, stored with a customer's
    lines side by side, so that every aggregate per customer shrinks before its
    shuffle, however many tasks read the table. AQE splits a hot customer's partition.
    The invoice number and the description are only counted: a mark stands for them.
    Flags and calendar parts are computed again when it is read."""
    lines = valid_sales(clean, known_customer=True).select(*CUSTOMER_LINE_COLUMNS)
    marks = {c: F.when(F.col(c).isNotNull(), F.lit("")) for c in ("InvoiceNo", "Description")}
    stored = materialize(lines.withColumns(marks).hint("rebalance", "CustomerID"), "customer_lines")
    ts = F.col("invoice_datetime")
    return stored.select(
        "*", F.lit(False).alias("is_return"), F.lit(False).alias("is_cancellation"), F.hour(ts).alias("hour"),
        flag_weekend(F.dayofweek(ts)).alias("is_weekend"))


def customer_features(
    clean: DataFrame, as_of=None, c360: DataFrame | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """customer_360 + 31 behaviour/temporal/spending/affinity/engagement
    features + 6 derived, numeric NULLs filled with 0 (62 columns).
    ``c360`` may be a stored customer_360 table."""
    if c360 is not None:
        base = c360
    else:
        base = customer_360(clean, as_of=as_of, num_partitions=num_partitions)
    vk = valid_sales(clean, known_customer=True)
    per_customer = customer_line_features(vk, as_of=as_of).join(
        purchase_gap_features(vk), "CustomerID", "left"
    )
    joined = base.join(per_customer, "CustomerID", "left")
    return fill_numeric_zero(derived_ratios(joined)).select(*CUSTOMER_FEATURE_COLUMNS)


def customer_feature_sample(cf: DataFrame, n: int = 5) -> DataFrame:
    """Projection, first ``n`` rows in key order (no ``value_tier``: the
    reference never defines it)."""
    return cf.select(
        "CustomerID", "Country", "recency_days", "frequency", "monetary",
        "avg_transaction_value", "unique_products", "engagement_score_fe", "customer_segment",
    ).orderBy("CustomerID", "Country").limit(n)


# --------------------------------------------------------------- products

POPULARITY_FE = [
    "purchase_count_fe", "unique_buyers_fe", "total_quantity_sold_fe", "avg_price_fe",
    "price_volatility",
]


def product_popularity(pls: DataFrame) -> DataFrame:
    """Per StockCode, rolled up from the per-(StockCode, Description)
    table (``gold.product_line_stats``) instead of re-reading the lines.

    The sample stddev of UnitPrice combines the groups' counts, means and
    second moments (parallel-variance formula, the merge Spark's own
    ``stddev`` uses): M2 = sum(M2_g + n_g * (mean_g - mean)^2)."""
    means = pls.groupBy("StockCode").agg(
        safe_div(F.sum(F.col("avg_price") * F.col("_n_unit")), F.sum("_n_unit")).alias("_mean_code")
    )
    parts = pls.select(
        "StockCode", "times_purchased", "unique_customers", "total_quantity_sold",
        "avg_price", "_n_unit", "_m2_unit",
    ).join(means, "StockCode")
    n = F.sum("_n_unit")
    m2 = F.sum(F.col("_m2_unit") + F.col("_n_unit") * F.pow(F.col("avg_price") - F.col("_mean_code"), 2))
    return parts.groupBy("StockCode").agg(
        F.sum("times_purchased").alias("purchase_count_fe"),
        F.sum("unique_customers").alias("unique_buyers_fe"),
        F.sum("total_quantity_sold").alias("total_quantity_sold_fe"),
        F.first("_mean_code").alias("avg_price_fe"),
        F.when(n > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (n - 1))).alias("price_volatility"),
    )


# Price tiers on avg_transaction_value (lower bound, label).
PRICE_TIERS = [(10, "Premium"), (5, "Mid-Range")]
PRICE_TIER_DEFAULT = "Budget"


def price_tier(col: str = "avg_transaction_value"):
    """E18."""
    expr = None
    for bound, label in PRICE_TIERS:
        cond = F.col(col) >= bound
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(PRICE_TIER_DEFAULT)


def product_features(clean: DataFrame, pm: DataFrame | None = None) -> DataFrame:
    """product_metrics + popularity + 4 derived (24 columns). Without a
    stored ``pm`` both come from one stored pass over the lines."""
    pls = materialized_product_stats(clean)
    metrics = pm if pm is not None else product_metrics(None, pls=pls)
    joined = metrics.join(product_popularity(pls), "StockCode", "left")
    derived = joined.select(
        "*",
        popularity_score().alias("popularity_score"),
        price_tier().alias("price_tier"),
        velocity_score().alias("velocity_score"),
        customer_concentration().alias("customer_concentration"),
    )
    return fill_numeric_zero(derived)


def popularity_score(buyers: str = "unique_buyers"):
    """ln(buyers + 1), 0 when there are none."""
    return F.when(F.col(buyers) > 0, F.log(F.col(buyers) + 1)).otherwise(F.lit(0.0))


def velocity_score(revenue: str = "total_revenue", frequency: str = "purchase_frequency"):
    """Revenue per purchase, 0 without purchases."""
    return ratio_or_zero(revenue, frequency)


def customer_concentration(buyers: str = "unique_buyers", frequency: str = "purchase_frequency"):
    """Buyers per purchase, 0 without purchases."""
    return ratio_or_zero(buyers, frequency)


def product_feature_sample(pf: DataFrame, n: int = 5) -> DataFrame:
    """6 columns by revenue, top ``n``."""
    return (
        pf.select("StockCode", "Description", "total_revenue", "unique_buyers",
                  "popularity_score", "price_tier")
        .orderBy(F.col("total_revenue").desc_nulls_last(), "StockCode", "Description")
        .limit(n)
    )


def basket_items(clean: DataFrame) -> DataFrame:
    """The items bought together on each invoice — one row per
    (InvoiceNo, StockCode) with how many lines carried it (the reference's
    per-invoice list, in long form). Distributed at any basket size: no
    invoice is ever collected into one row or one task."""
    return valid_sales(clean).groupBy("InvoiceNo", "StockCode").agg(
        F.count(F.lit(1)).alias("lines")
    )


# ----------------------------------------------------------- transactions

CUSTOMER_STATS = [
    "customer_avg_price", "customer_std_price", "customer_avg_quantity", "customer_std_quantity",
]
TRANSACTION_FEATURE_COLUMNS = (
    ["CustomerID"] + [c for c in SILVER_COLUMNS if c != "CustomerID"] + CUSTOMER_STATS
    + ["price_zscore", "quantity_zscore", "is_business_hours", "is_night_purchase"]
)


def customer_price_stats(clean: DataFrame) -> DataFrame:
    """Mean / sample stddev of line amount and quantity per known customer,
    over all clean lines (returns and cancellations included)."""
    return clean.where(F.col("CustomerID").isNotNull()).groupBy("CustomerID").agg(
        F.avg("total_price").alias("customer_avg_price"),
        F.stddev("total_price").alias("customer_std_price"),
        F.avg("Quantity").alias("customer_avg_quantity"),
        F.stddev("Quantity").alias("customer_std_quantity"),
    )


def _zscore(x: str, mean: str, std: str):
    s = F.col(std)
    return F.when(s > 0, (F.col(x) - F.col(mean)) / s).otherwise(F.lit(0.0))


def guest_salted_key(customer: str = "CustomerID", spread_by: str = "record_hash"):
    """Join key for lines: the customer id, or for a guest line its record's
    hash moved below the int range — never equal to a real id, so a guest never
    matches, and guests spread over as many keys as there are records."""
    salt = F.lit(-(1 << 32)) - F.shiftrightunsigned(F.xxhash64(spread_by), 2)
    return F.coalesce(F.col(customer).cast("long"), salt)


#: customers with at least this share of the lines are hot: there are at most its inverse
HOT_SHARE = 1 / 200
#: keys that a hot customer's lines are spread over
HOT_SALTS = 64


def hot_customers(lines: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """Customers with at least ``share`` of the lines, from a bounded sketch of the
    most frequent ids (one narrow pass). The sketch overstates a count at most by
    its error, so no hot customer is missed; there are at most about 1 / share."""
    k = int(round(1 / share))
    known = lines.select("CustomerID").where("CustomerID IS NOT NULL")
    top = known.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(CustomerID, {k}, {32 * k})").alias("top"))
    return top.select("n", F.explode("top").alias("at")).where(F.col("at.count") >= F.col("n") * share).select(
        F.col("at.item").alias("CustomerID"))


def transaction_features(clean: DataFrame, hot_share: float = HOT_SHARE, salts: int = HOT_SALTS) -> DataFrame:
    """Lines + customer stats, z-scores and hour flags (31 columns).

    The lines are shuffled once, by customer, with the stored columns only (the hash as
    its bytes, or left out where ``clean`` has ``silver.RAW_CODE`` to compute it from; the
    derived ones are computed again), and the stats of E23 are a window
    over that layout. No key is hot: guests have no stats and are spread by their
    record; the lines of the few hot customers (``hot_customers``) are spread over
    ``salts`` keys, and their stats, at most 1 / share rows, are aggregated apart and
    broadcast. ``clean`` is read three times: store it."""
    hot = materialize(hot_customers(clean, hot_share), "hot_customers")
    hot_stats = customer_price_stats(clean.join(F.broadcast(hot), "CustomerID", "left_semi")).select(
        F.col("CustomerID").alias("_tr_id"), *[F.col(c).alias(f"_tr_{c}") for c in CUSTOMER_STATS])
    salt = F.when(F.col("_tr_hot"), F.pmod(F.xxhash64("record_hash"), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    raw = RAW_CODE in clean.columns
    lines = clean.join(F.broadcast(hot.withColumn("_tr_hot", F.lit(True))), "CustomerID", "left")
    # what lines share comes first, what an invoice's share next: equal bytes lie together
    own_code = RAW_CODE if raw else "StockCode"
    carried = ["source_file", "bronze_layer_version", "ingestion_timestamp", "Country", "InvoiceDate", "InvoiceNo",
               "CustomerID", "invoice_datetime", "Description", own_code, "Quantity", "UnitPrice"]
    dealt = lines.select(guest_salted_key().alias("_tr_key"), salt.alias("_tr_salt"), *carried,
                         (spared_hash() if raw else packed_hash()).alias("record_hash"))
    own = Window.partitionBy("_tr_key", "_tr_salt")
    price, known = line_amount(), F.col("CustomerID").isNotNull()
    of_group = {"customer_avg_price": F.avg(price), "customer_std_price": F.stddev(price),
                "customer_avg_quantity": F.avg("Quantity"), "customer_std_quantity": F.stddev("Quantity")}
    grouped = dealt.select("*", *[v.over(own).alias(c) for c, v in of_group.items()])
    joined = grouped.join(F.broadcast(hot_stats), F.col("CustomerID") == F.col("_tr_id"), "left")
    stats = {c: F.when(F.col("_tr_id").isNotNull(), F.col(f"_tr_{c}")).when(known, F.col(c)) for c in CUSTOMER_STATS}
    restored = {"record_hash": restored_hash(), "StockCode": normalize_stock_code(RAW_CODE)} if raw else {"record_hash": unpacked_hash()}
    whole = joined.withColumns(stats).withColumns(restored)
    return hour_flags(zscores(enrich(whole, CUSTOMER_STATS))).select(*TRANSACTION_FEATURE_COLUMNS)


def known_transaction_features(known: DataFrame) -> DataFrame:
    """E24-E27 for lines with a customer that are stored dealt by customer
    (``sources.layouts``): statistics and join run where the lines lie."""
    joined = known.join(customer_price_stats(known).hint("merge"), "CustomerID", "left")
    return hour_flags(zscores(joined)).select(*TRANSACTION_FEATURE_COLUMNS)


def zscores(lines: DataFrame) -> DataFrame:
    """(x - mean) / std for line amount and quantity, 0 when the
    customer's std is NULL or 0."""
    return lines.select(
        "*",
        _zscore("total_price", "customer_avg_price", "customer_std_price").alias("price_zscore"),
        _zscore("Quantity", "customer_avg_quantity", "customer_std_quantity").alias("quantity_zscore"),
    )


def hour_flags(lines: DataFrame) -> DataFrame:
    """Business hours 9-17 and night 22-6 as 0/1."""
    hour = F.col("hour")
    return lines.select(
        "*",
        F.when((hour >= 9) & (hour <= 17), 1).otherwise(0).alias("is_business_hours"),
        F.when((hour >= 22) | (hour <= 6), 1).otherwise(0).alias("is_night_purchase"),
    )
