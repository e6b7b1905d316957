"""Naive plan shapes, kept only as a benchmark baseline.

Same results as the operators, built the plain way: sibling aggregates re-reading the lines and joined back, the last date
collected to the driver, ``ntile`` over an unpartitioned window (one task),
three separate quantile jobs, a per-customer ``lag`` window over all lines.
``bench.py`` times these against the operators on the same data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import ratio_or_zero, safe_div
from tillroll.operators import gold as G
from tillroll.operators import silver as S
from tillroll.operators.features import CUSTOMER_FEATURE_COLUMNS, derived_ratios, fill_numeric_zero


def customer_360_naive(clean: DataFrame, as_of=None) -> DataFrame:
    v = S.valid_sales(clean, known_customer=True)
    profiles = S.customer_profiles(clean, as_of=as_of)
    last = v.agg(F.max("invoice_datetime")).collect()[0][0]
    rfm = v.groupBy("CustomerID").agg(
        F.datediff(F.to_date(F.lit(str(last))), F.max("invoice_datetime")).alias("recency_days"),
        F.count("InvoiceNo").alias("frequency"),
        F.sum("total_price").alias("monetary"),
    )
    scored = (
        rfm.withColumn("r_score", (6 - F.ntile(5).over(Window.orderBy("recency_days", "CustomerID"))).cast("int"))
        .withColumn("f_score", F.ntile(5).over(Window.orderBy("frequency", "CustomerID")))
        .withColumn("m_score", F.ntile(5).over(Window.orderBy("monetary", "CustomerID")))
        .withColumn("rfm_score", F.concat_ws("", "r_score", "f_score", "m_score"))
        .withColumn("customer_segment", G.rfm_segment(F.col("r_score"), F.col("f_score")))
    )
    behavior = v.groupBy("CustomerID").agg(
        F.avg("total_price").alias("avg_order_value"),
        F.max("total_price").alias("max_order_value"),
        F.min("total_price").alias("min_order_value"),
        F.count(F.lit(1)).alias("unique_invoices"),
        (F.sum("total_price") / F.count(F.lit(1))).alias("avg_basket_value"),
        F.avg("Quantity").alias("avg_items_per_transaction"),
    )
    diversity = v.groupBy("CustomerID").agg(
        F.count("StockCode").alias("unique_products"),
        F.count("Description").alias("unique_categories"),
    )
    temporal = v.groupBy("CustomerID").agg(
        F.avg(F.when(F.col("is_weekend"), 1).otherwise(0)).alias("weekend_purchase_ratio"),
        F.avg("hour").alias("avg_purchase_hour"),
    )
    return (
        profiles.join(scored, "CustomerID", "left")
        .join(behavior, "CustomerID", "left")
        .join(diversity, "CustomerID", "left")
        .join(temporal, "CustomerID", "left")
        .select(*G.CUSTOMER_360_COLUMNS)
    )


def product_metrics_naive(clean: DataFrame, rel_error: float = 1e-5) -> DataFrame:
    v = S.valid_sales(clean)
    products = S.product_catalog(clean)
    perf = v.groupBy("StockCode").agg(
        F.sum("total_price").alias("total_revenue_gold"),
        F.sum("Quantity").alias("total_quantity_gold"),
        F.count(F.lit(1)).alias("unique_buyers"),
        F.avg("total_price").alias("avg_transaction_value"),
        F.count("InvoiceNo").alias("purchase_frequency"),
    )
    gold = (
        products.drop("total_revenue", "total_quantity_sold")
        .join(perf, "StockCode", "left")
        .withColumnRenamed("total_revenue_gold", "total_revenue")
        .withColumnRenamed("total_quantity_gold", "total_quantity_sold")
    )
    q80 = gold.approxQuantile("total_revenue", [0.8], rel_error)[0]
    q50 = gold.approxQuantile("total_revenue", [0.5], rel_error)[0]
    q20 = gold.approxQuantile("total_revenue", [0.2], rel_error)[0]
    r = F.col("total_revenue")
    return gold.withColumn(
        "performance_category",
        F.when(r >= q80, "Star Products").when(r >= q50, "Good Performers")
        .when(r >= q20, "Average").otherwise("Underperformers"),
    ).select(*G.PRODUCT_METRICS_COLUMNS)


def customer_features_naive(clean: DataFrame, c360: DataFrame, as_of=None) -> DataFrame:
    asof = G.as_of_date(as_of)
    v = S.valid_sales(clean, known_customer=True)
    ts, price = F.col("invoice_datetime"), F.col("total_price")
    behavior = v.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("purchase_frequency_fe"),
        F.avg(price).alias("avg_transaction_value_fe"),
        F.stddev(price).alias("std_transaction_value"),
        F.max(price).alias("max_transaction_value_fe"),
        F.min(price).alias("min_transaction_value_fe"),
        F.avg("Quantity").alias("avg_items_per_order_fe"),
        F.max("Quantity").alias("max_items_per_order"),
        F.count("StockCode").alias("total_products_purchased"),
        F.size(F.collect_list("StockCode")).alias("unique_products_fe"),
        F.avg(F.when(F.col("is_weekend"), 1).otherwise(0)).alias("weekend_purchase_ratio_fe"),
        F.avg("hour").alias("avg_purchase_hour_fe"),
        F.stddev("hour").alias("std_purchase_hour"),
    )
    w = Window.partitionBy("CustomerID").orderBy("invoice_datetime")
    gaps = v.withColumn("_gap", F.datediff(ts, F.lag(ts).over(w))).groupBy("CustomerID").agg(
        F.avg("_gap").alias("avg_days_between_purchases_fe"),
        F.stddev("_gap").alias("std_days_between_purchases"),
        F.min("_gap").alias("min_days_between_purchases"),
        F.max("_gap").alias("max_days_between_purchases"),
    )
    spending = v.groupBy("CustomerID").agg(
        F.sum(price).alias("total_lifetime_value_fe"),
        safe_div(F.sum(price), F.count("InvoiceNo")).alias("avg_basket_value_fe"),
        F.sum(F.when(F.datediff(asof, ts) <= 30, price).otherwise(0)).alias("spending_last_30_days"),
        F.sum(F.when(F.datediff(asof, ts) <= 90, price).otherwise(0)).alias("spending_last_90_days"),
    ).withColumn("spending_trend_30_vs_90", ratio_or_zero("spending_last_30_days", "spending_last_90_days"))
    affinity = v.groupBy("CustomerID").agg(
        F.count("StockCode").alias("product_variety"),
        F.size(F.array_distinct(F.collect_list("StockCode"))).alias("unique_stock_codes"),
    )
    engagement = v.groupBy("CustomerID").agg(
        F.count("InvoiceNo").alias("total_invoices_fe"),
        F.datediff(asof, F.max(ts)).alias("recency_days_fe"),
        F.datediff(F.max(ts), F.min(ts)).alias("customer_age_days_fe"),
    ).withColumn(
        "engagement_score_fe",
        F.when(F.col("customer_age_days_fe") > 0,
               F.col("total_invoices_fe") / (F.col("customer_age_days_fe") / 30)).otherwise(F.lit(0.0)),
    )
    joined = (
        c360.join(behavior, "CustomerID", "left").join(gaps, "CustomerID", "left")
        .join(spending, "CustomerID", "left").join(affinity, "CustomerID", "left")
        .join(engagement, "CustomerID", "left")
    )
    return fill_numeric_zero(derived_ratios(joined)).select(*CUSTOMER_FEATURE_COLUMNS)
