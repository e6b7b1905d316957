"""Mergeable sketches beside the marts: quantiles and distinct counts of any slice.

Built once per (date, Country) in one pass over the lines, stored, and merged for any
set of days, months or countries without reading a line again.

* KLL sketches of the line amount answer quantiles within ``QUANTILE_K``'s rank error
  (about 0.4 % for 800). The exact ranking stays the default of the marts.
* Theta sketches of customers and products answer distinct counts: exact up to
  2^``THETA_LG`` values, within about 1 % (three standard errors: 2.4 %) beyond.
  Sketches intersect, which gives the customers of one month who had bought in another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.silver import valid_sales

QUANTILE_K = 800
THETA_LG = 14


def daily_sketches(clean: DataFrame) -> DataFrame:
    """One row per (date, Country) of valid lines: their number and the sketches of
    amounts, customers and products. Lines are aggregated once; no line is expanded
    per distinct column."""
    return valid_sales(clean).groupBy(F.to_date("invoice_datetime").alias("date"), "Country").agg(
        F.count("total_price").alias("amounts"), F.kll_sketch_agg_double("total_price", F.lit(QUANTILE_K)).alias("amount_sketch"),
        F.theta_sketch_agg("CustomerID", F.lit(THETA_LG)).alias("customer_sketch"),
        F.theta_sketch_agg("StockCode", F.lit(THETA_LG)).alias("product_sketch"))


def merged(sketches: DataFrame, by: Sequence) -> DataFrame:
    """The sketches of every group of ``by`` (columns of the stored rows)."""
    return sketches.groupBy(*by).agg(
        F.sum("amounts").alias("amounts"), F.kll_merge_agg_double("amount_sketch", F.lit(QUANTILE_K)).alias("amount_sketch"),
        F.theta_union_agg("customer_sketch", F.lit(THETA_LG)).alias("customer_sketch"),
        F.theta_union_agg("product_sketch", F.lit(THETA_LG)).alias("product_sketch"))


def amount_quantiles(sketches: DataFrame, by: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """Quantiles of the line amount: a row per group and percent."""
    points = F.array(*[F.struct(F.lit(p).alias("percent"), F.kll_sketch_get_quantile_double("amount_sketch", F.lit(p / 100)).alias("amount"))
                       for p in percents])
    return merged(sketches, by).where("amounts > 0").select(*by, F.explode(points).alias("at")).select(*by, "at.percent", "at.amount")


def amount_bands(clean: DataFrame, quantiles: DataFrame, key: str = "Country") -> DataFrame:
    """Where quantiles of a stored sketch truly stand among the lines of their group:
    the shares of amounts below and not above each (one pass over the lines, the few
    quantiles of a group beside each line)."""
    bounds = quantiles.groupBy(key).agg(F.collect_list(F.struct("percent", "amount")).alias("bounds"))
    lines = valid_sales(clean).where("total_price IS NOT NULL").select(key, "total_price").join(bounds, key)
    hit = lines.select(key, "total_price", F.explode("bounds").alias("at"))
    return hit.groupBy(key, F.col("at.percent").alias("percent")).agg(
        F.count(F.lit(1)).alias("amounts"), F.avg((F.col("total_price") < F.col("at.amount")).cast("double")).alias("below"),
        F.avg((F.col("total_price") <= F.col("at.amount")).cast("double")).alias("up_to"))


def monthly_distinct(sketches: DataFrame) -> DataFrame:
    """Per month, all countries together: distinct customers and products, and the
    customers who had also bought in the month before."""
    month = (F.year("date") * 12 + F.month("date") - 1).alias("month_number")
    months = merged(sketches.withColumn("month_number", month), ["month_number"])
    before = months.select((F.col("month_number") + 1).alias("month_number"), F.col("customer_sketch").alias("earlier"))
    both = F.theta_sketch_estimate(F.theta_intersection("customer_sketch", "earlier"))
    return months.join(before, "month_number", "left").select(
        F.floor(F.col("month_number") / 12).cast("int").alias("year"), (F.col("month_number") % 12 + 1).cast("int").alias("month"),
        F.theta_sketch_estimate("customer_sketch").alias("distinct_customers"),
        F.theta_sketch_estimate("product_sketch").alias("distinct_products"),
        F.coalesce(F.when(F.col("earlier").isNotNull(), both), F.lit(0).cast("long")).alias("returning_customers"))
