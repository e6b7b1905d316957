"""Read-only lookups over the marts (G1-G7), as DataFrames.

Each lookup is one aggregate job (the original ran one job per number) and
rounds with SQL HALF_UP rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _money(c, places: int = 2):
    return F.round(F.coalesce(c, F.lit(0.0)), places)


def customer_overview(c360: DataFrame, active_days: int = 90) -> DataFrame:
    """G1: customer rows, rows active within ``active_days``, revenue total and
    mean. Rows are (customer, country); ``distinct_customers`` counts people."""
    return c360.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_distinct("CustomerID").alias("distinct_customers"),
        F.count_if(F.col("recency_days") <= active_days).alias("active_customers"),
        _money(F.sum("monetary")).alias("total_revenue"),
        _money(F.avg("monetary")).alias("avg_customer_value"),
    )


def product_overview(pm: DataFrame) -> DataFrame:
    """Product rows, purchases, mean of average prices."""
    return pm.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.coalesce(F.sum("times_purchased"), F.lit(0)).cast("long").alias("total_transactions"),
        _money(F.avg("avg_price")).alias("avg_product_price"),
    )


def segments_summary(segments: DataFrame) -> DataFrame:
    """Per segment name: customers, revenue, mean frequency; by revenue."""
    return (
        segments.groupBy("segment_name")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            _money(F.sum("monetary")).alias("total_revenue"),
            _money(F.avg("frequency")).alias("avg_frequency"),
        )
        .orderBy(F.col("total_revenue").desc(), "segment_name")
    )


def list_segments(segments: DataFrame) -> DataFrame:
    """Distinct segment names, ascending."""
    return segments.select("segment_name").distinct().orderBy("segment_name")


def segment_detail(segments: DataFrame, name: str) -> DataFrame:
    """One row of statistics for ``name``; empty when the name is unknown."""
    stats = segments.where(F.col("segment_name") == F.lit(name)).agg(
        F.count(F.lit(1)).alias("customer_count"),
        _money(F.avg("recency_days")).alias("avg_recency"),
        _money(F.avg("frequency")).alias("avg_frequency"),
        _money(F.avg("monetary")).alias("avg_monetary"),
        _money(F.sum("monetary")).alias("total_revenue"),
    )
    return stats.where(F.col("customer_count") > 0).select(
        F.lit(name).alias("segment_name"), "*"
    )


def customer_segment(segments: DataFrame, customer_id: int) -> DataFrame:
    """The segment row of one customer (first by cluster, value); empty
    when unknown."""
    return (
        segments.where(F.col("CustomerID") == F.lit(int(customer_id)))
        .orderBy("cluster_id", "avg_transaction_value", "segment_name")
        .limit(1)
        .select(
            F.col("CustomerID").alias("customer_id"),
            "segment_name",
            "cluster_id",
            "recency_days",
            "frequency",
            F.round("monetary", 2).alias("monetary"),
            F.round("avg_transaction_value", 2).alias("avg_transaction_value"),
        )
    )


def revenue_trends(daily: DataFrame) -> DataFrame:
    """The daily mart summed over countries, one row per date."""
    return daily.groupBy("date").agg(
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_items_sold").alias("total_items_sold"),
        F.count(F.lit(1)).alias("countries"),
    )
