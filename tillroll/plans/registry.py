"""Registered queries: Spark callables and their DuckDB oracle SQL side by side.

Every query reads the driver's tables (through the FIXTURES adapter) and runs
the whole chain lazily: raw -> bronze -> clean -> marts. Double columns are
rounded to ``oracle.PLACES`` on both sides (sums of doubles differ in the last
bits between engines); the reference's own roundings are kept inside.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from tillroll.operators import baskets as BK
from tillroll.operators import bronze as B
from tillroll.operators import features as FE
from tillroll.operators import gold as G
from tillroll.operators import segmentation as SG
from tillroll.operators import serving as SV
from tillroll.operators import silver as S
from tillroll.operators import sketches as SK
from tillroll.operators.silver import valid_sales
from tillroll.plans import oracle as O
from tillroll.plans import refresh as RF
from tillroll.session import ensure_checkpoint_dir, materialize
from tillroll.sources.schema import INVOICE_TS_FORMAT
from tillroll.sources.tables import raw_invoice_lines

AS_OF = O.AS_OF
INGESTED_AT = O.INGESTED_AT


def round_doubles(df: DataFrame, places: int = O.PLACES) -> DataFrame:
    """Comparison rounding of double columns (see ``oracle.NUDGE``)."""
    cols = [
        F.round(F.col(f.name) + F.lit(O.NUDGE), places).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


# ------------------------------------------------------------- chain pieces

def bronze_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the lines come from a join, which has no one input file: name the fact table
    return B.add_lineage(raw_invoice_lines(spark, sf_dir), ingested_at=INGESTED_AT, source_file="lineitem.parquet")


def clean_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.clean_transactions(bronze_df(spark, sf_dir))


def stored_clean_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean lines stored once, for queries that read them more than once."""
    return S.stored_clean(bronze_df(spark, sf_dir))


def transaction_features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.transaction_features(S.stored_clean(bronze_df(spark, sf_dir), raw_code=True))


def c360_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.customer_360(clean_df(spark, sf_dir), as_of=AS_OF)


def pm_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.product_metrics(clean_df(spark, sf_dir))


def cf_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FE.customer_features(FE.customer_lines(S.lean_clean(bronze_df(spark, sf_dir))), as_of=AS_OF)


def refreshed_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Marts after two loads that together hold all lines; the second brings half a
    year of the first once more."""
    raw = materialize(raw_invoice_lines(spark, sf_dir), "raw_lines")
    at = F.try_to_timestamp("InvoiceDate", F.lit(INVOICE_TS_FORMAT))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/refreshed-{uuid.uuid4().hex}"
    for load in (raw.where(F.coalesce(at < "1996-01-01", F.lit(True))), raw.where(at >= "1995-07-01")):
        RF.add_load(B.add_lineage(load, ingested_at=INGESTED_AT, source_file="lineitem.parquet"), base)
    return RF.marts(spark, base, as_of=AS_OF)


def amount_quantile_error_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sketches' quantiles stand from the lines' (whether within 1 %)."""
    clean = stored_clean_df(spark, sf_dir)
    sketches = materialize(SK.daily_sketches(clean), "sketches")
    bands = SK.amount_bands(clean, materialize(SK.amount_quantiles(sketches, ["Country"], [20, 50, 80]), "quantiles"))
    at = F.col("percent") / 100
    return bands.select("Country", "percent", "amounts", ((F.col("below") <= at + 0.01) & (F.col("up_to") >= at - 0.01)).alias("within_one_percent"))


def segmented_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, segmented = SG.segment(cf_df(spark, sf_dir))
    return segmented


def segments_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SG.customer_segments(segmented_df(spark, sf_dir))


def scaled_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SG.scaled_features(materialize(SG.prepare_features(cf_df(spark, sf_dir)), "prepared"))


def centre_segmented_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SG.assign_segments(SG.assign_to_centres(scaled_df(spark, sf_dir), O.CENTRES))


def centre_segments_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SG.customer_segments(centre_segmented_df(spark, sf_dir))


# ------------------------------------------------------------------ registry

@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    survey: str = ""

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.run(spark, sf_dir))

    def oracle(self) -> str | None:
        return None if self.sql is None else O.rounded(self.sql, self.doubles)


CLEAN_DOUBLES = ["UnitPrice", "total_price"]
CUSTOMER_DOUBLES = ["total_spent", "avg_transaction_value", "avg_days_between_purchases"]
C360_DOUBLES = CUSTOMER_DOUBLES + [
    "monetary", "avg_order_value", "max_order_value", "min_order_value", "avg_basket_value",
    "avg_items_per_transaction", "weekend_purchase_ratio", "avg_purchase_hour",
]
PRODUCT_DOUBLES = ["avg_price", "min_price", "max_price", "total_revenue",
                   "avg_quantity_per_order", "revenue_per_customer"]
PM_DOUBLES = PRODUCT_DOUBLES + ["avg_transaction_value"]
DAILY_DOUBLES = ["total_revenue", "avg_transaction_value", "revenue_ma_7d", "revenue_ma_30d",
                 "transactions_ma_7d"]
COUNTRY_DOUBLES = ["total_revenue", "avg_order_value", "revenue_share", "revenue_per_customer"]
CF_DOUBLES = C360_DOUBLES + [
    "avg_transaction_value_fe", "std_transaction_value", "max_transaction_value_fe",
    "min_transaction_value_fe", "avg_items_per_order_fe", "weekend_purchase_ratio_fe",
    "avg_purchase_hour_fe", "std_purchase_hour", "avg_days_between_purchases_fe",
    "std_days_between_purchases", "total_lifetime_value_fe", "avg_basket_value_fe",
    "spending_last_30_days", "spending_last_90_days", "spending_trend_30_vs_90",
    "engagement_score_fe", "clv_to_frequency_ratio", "recency_to_age_ratio", "log_monetary",
    "sqrt_frequency", "purchase_regularity", "spending_consistency",
]
PF_DOUBLES = PM_DOUBLES + ["avg_price_fe", "price_volatility", "popularity_score",
                           "velocity_score", "customer_concentration"]
TF_DOUBLES = CLEAN_DOUBLES + FE.CUSTOMER_STATS + ["price_zscore", "quantity_zscore"]

SEGMENT_DOUBLES = ["monetary", "avg_transaction_value", "engagement_score_fe"]
PROFILE_DOUBLES = ["avg_recency_days", "avg_frequency", "avg_monetary", "avg_transaction_value", "avg_unique_products",
                   "avg_engagement_score_fe"]
#: the segment that the detail queries show
SHOWN_SEGMENT = "At Risk"

_NF = "NULLS FIRST"
SAMPLE_ORDER = ", ".join(f"{c} ASC {_NF}" for c in B.SAMPLE_COLUMNS)


def _registry() -> dict[str, Query]:
    w = O.with_layers
    q: dict[str, Query] = {}

    # ---- bronze
    q["bronze_transactions"] = Query(
        bronze_df, w("bronze", "SELECT * EXCLUDE (_ts) FROM bronze"), ["UnitPrice"], "B1 B2 A2")
    q["bronze_quality"] = Query(
        lambda s, d: B.bronze_quality(bronze_df(s, d)),
        w("bronze", "SELECT count(*) AS total_rows, "
                    "count(*) FILTER (WHERE CustomerID IS NULL) AS null_customers, "
                    f"{O.r('CAST(count(*) FILTER (WHERE CustomerID IS NULL) AS DOUBLE) * 100 / count(*)')} AS null_customers_pct, "
                    "count(*) FILTER (WHERE Quantity < 0) AS negative_quantities FROM bronze"),
        ["null_customers_pct"], "B3")
    q["bronze_sample"] = Query(
        lambda s, d: B.bronze_sample(bronze_df(s, d)),
        w("bronze", f"SELECT {', '.join(B.SAMPLE_COLUMNS)} FROM bronze ORDER BY {SAMPLE_ORDER} LIMIT 5"),
        ["UnitPrice"], "B4")

    # ---- silver
    q["transactions_clean"] = Query(
        clean_df, w("clean", "SELECT * FROM clean"), CLEAN_DOUBLES, "C1-C13")
    q["customers"] = Query(
        lambda s, d: S.customer_profiles(clean_df(s, d), as_of=AS_OF),
        w("customers", "SELECT * FROM customers"), CUSTOMER_DOUBLES, "C14 C15")
    q["products"] = Query(
        lambda s, d: S.product_catalog(clean_df(s, d)),
        w("products", "SELECT * FROM products"), PRODUCT_DOUBLES, "C16 C17")
    pct = lambda cond: O.r(f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) * 100 / count(*)")
    q["silver_quality"] = Query(
        lambda s, d: S.silver_quality(clean_df(s, d)),
        w("clean", "SELECT count(*) AS total_records, "
                   "count(*) FILTER (WHERE is_return) AS returns, "
                   f"{pct('is_return')} AS returns_pct, "
                   "count(*) FILTER (WHERE is_cancellation) AS cancellations, "
                   f"{pct('is_cancellation')} AS cancellations_pct, "
                   "count(*) FILTER (WHERE CustomerID IS NOT NULL) AS valid_customers, "
                   f"{pct('CustomerID IS NOT NULL')} AS valid_customers_pct FROM clean"),
        ["returns_pct", "cancellations_pct", "valid_customers_pct"], "C18")
    q["silver_date_range"] = Query(
        lambda s, d: S.silver_date_range(clean_df(s, d)),
        w("clean", "SELECT min(invoice_datetime) AS min_date, max(invoice_datetime) AS max_date FROM clean"),
        [], "C19")
    q["silver_price_stats"] = Query(
        lambda s, d: S.silver_price_stats(clean_df(s, d)),
        w("clean", "SELECT min(total_price) AS min_total_price, avg(total_price) AS avg_total_price, "
                   "max(total_price) AS max_total_price FROM clean WHERE NOT is_return"),
        ["min_total_price", "avg_total_price", "max_total_price"], "C20")
    q["catalog_top_products"] = Query(
        lambda s, d: S.catalog_top_products(S.product_catalog(clean_df(s, d))),
        w("products", "SELECT * FROM products ORDER BY total_revenue DESC NULLS LAST, StockCode, Description LIMIT 10"),
        PRODUCT_DOUBLES, "C21")
    q["customer_sample"] = Query(
        lambda s, d: S.customer_sample(S.customer_profiles(clean_df(s, d), as_of=AS_OF)),
        w("customers", "SELECT * FROM customers ORDER BY CustomerID, Country LIMIT 10"),
        CUSTOMER_DOUBLES, "C22")

    # ---- gold: customers
    q["rfm_scores"] = Query(
        lambda s, d: G.rfm_table(clean_df(s, d)),
        w("c360", "SELECT CustomerID, recency_days, frequency, monetary, r_score, f_score, m_score, "
                  "rfm_score, customer_segment FROM seg"),
        ["monetary"], "D2-D6")
    q["customer_360"] = Query(c360_df, w("c360", "SELECT * FROM c360"), C360_DOUBLES, "D1-D10")
    q["segment_distribution"] = Query(
        lambda s, d: G.segment_distribution(c360_df(s, d)),
        w("c360", f"SELECT customer_segment, count(*) AS count, {O.r('avg(monetary)')} AS avg_revenue, "
                  f"{O.r('avg(frequency)')} AS avg_frequency FROM c360 GROUP BY customer_segment"),
        ["avg_revenue", "avg_frequency"], "D11")

    q["customer_distinct_counts"] = Query(
        lambda s, d: G.distinct_counts(clean_df(s, d), "customer"),
        w("clean", "SELECT CustomerID, count(DISTINCT InvoiceNo) AS distinct_invoices, "
                   "count(DISTINCT StockCode) AS distinct_products, "
                   "count(DISTINCT Description) AS distinct_categories FROM vk GROUP BY CustomerID"),
        [], "Q1 Q2 (customer grain)")
    q["country_distinct_counts"] = Query(
        lambda s, d: G.distinct_counts(clean_df(s, d), "country"),
        w("clean", "SELECT Country, count(DISTINCT CustomerID) AS distinct_customers, "
                   "count(DISTINCT StockCode) AS distinct_products FROM v GROUP BY Country"),
        [], "Q1 Q2 (country grain)")

    q["product_distinct_counts"] = Query(
        lambda s, d: G.distinct_counts(clean_df(s, d), "product"),
        w("clean", "SELECT StockCode, count(DISTINCT CustomerID) AS distinct_buyers, "
                   "count(DISTINCT InvoiceNo) AS distinct_invoices FROM v GROUP BY StockCode"),
        [], "Q1 Q2 (product grain)")
    q["daily_distinct_counts"] = Query(
        lambda s, d: G.distinct_counts(clean_df(s, d), "daily"),
        w("clean", "SELECT CAST(invoice_datetime AS DATE) AS date, Country, count(DISTINCT CustomerID) AS distinct_customers, "
                   "count(DISTINCT StockCode) AS distinct_products_sold FROM v GROUP BY ALL"),
        [], "Q1 Q2 (daily grain)")

    # ---- gold: products
    q["product_metrics"] = Query(pm_df, w("pm", "SELECT * FROM pm"), PM_DOUBLES, "D12-D15")
    q["top_products"] = Query(
        lambda s, d: G.top_products(pm_df(s, d)),
        w("pm", "SELECT StockCode, Description, total_revenue, total_quantity_sold, unique_buyers, "
                "performance_category FROM pm ORDER BY total_revenue DESC NULLS LAST, StockCode, Description LIMIT 10"),
        ["total_revenue"], "D16")

    # ---- gold: daily / country
    q["daily_aggregates"] = Query(
        lambda s, d: G.daily_aggregates(clean_df(s, d)),
        w("daily", "SELECT * FROM daily"), DAILY_DOUBLES, "D17-D20")
    q["recent_days"] = Query(
        lambda s, d: G.recent_days(G.daily_aggregates(clean_df(s, d))),
        w("daily", "SELECT * FROM daily ORDER BY date DESC, Country LIMIT 10"), DAILY_DOUBLES, "D21")
    q["country_analytics"] = Query(
        lambda s, d: G.country_analytics(clean_df(s, d)),
        w("country", "SELECT * FROM country"), COUNTRY_DOUBLES, "D22-D25")
    q["top_countries"] = Query(
        lambda s, d: G.top_countries(G.country_analytics(clean_df(s, d))),
        w("country", "SELECT * FROM country ORDER BY total_revenue DESC NULLS LAST, Country LIMIT 10"),
        COUNTRY_DOUBLES, "D26")

    # ---- the same marts after two loads, merged from parts by month
    for name, layer, doubles in (("customer_360", "c360", C360_DOUBLES), ("product_metrics", "pm", PM_DOUBLES),
                                 ("daily_aggregates", "daily", DAILY_DOUBLES), ("country_analytics", "country", COUNTRY_DOUBLES)):
        q[f"refreshed_{name}"] = Query(
            lambda s, d, n=name: refreshed_marts(s, d)[n], w(layer, f"SELECT * FROM {layer}"), doubles, "A10 A5")

    # ---- features
    q["purchase_gaps"] = Query(
        lambda s, d: FE.purchase_gap_features(valid_sales(clean_df(s, d), known_customer=True)),
        w("cf", "SELECT * FROM gf"), ["avg_days_between_purchases_fe", "std_days_between_purchases"], "E2 E3")
    q["customer_features"] = Query(cf_df, w("cf", "SELECT * FROM cf"), CF_DOUBLES, "E1-E12")
    q["customer_feature_sample"] = Query(
        lambda s, d: FE.customer_feature_sample(cf_df(s, d)),
        w("cf", "SELECT CustomerID, Country, recency_days, frequency, monetary, avg_transaction_value, "
                "unique_products, engagement_score_fe, customer_segment FROM cf ORDER BY CustomerID, Country LIMIT 5"),
        ["monetary", "avg_transaction_value", "engagement_score_fe"], "E13")
    q["product_features"] = Query(
        lambda s, d: FE.product_features(clean_df(s, d)),
        w("pf", "SELECT * FROM pf"), PF_DOUBLES, "E14 E16-E21")
    q["product_feature_sample"] = Query(
        lambda s, d: FE.product_feature_sample(FE.product_features(clean_df(s, d))),
        w("pf", "SELECT StockCode, Description, total_revenue, unique_buyers, popularity_score, price_tier "
                "FROM pf ORDER BY total_revenue DESC NULLS LAST, StockCode, Description LIMIT 5"),
        ["total_revenue", "popularity_score"], "E22")
    q["basket_items"] = Query(
        lambda s, d: FE.basket_items(clean_df(s, d)),
        w("clean", "SELECT InvoiceNo, StockCode, count(*) AS lines FROM v GROUP BY InvoiceNo, StockCode"),
        [], "E15")
    q["item_pairs"] = Query(
        lambda s, d: BK.item_pairs(clean_df(s, d), min_invoices=2),
        w("clean", "SELECT * FROM (WITH b AS (SELECT DISTINCT InvoiceNo, StockCode FROM v), "
                   "i AS (SELECT StockCode, count(*)::DOUBLE AS n FROM b GROUP BY StockCode), "
                   "t AS (SELECT count(DISTINCT InvoiceNo)::DOUBLE AS n FROM b), "
                   "p AS (SELECT x.StockCode AS item_a, y.StockCode AS item_b, count(*) AS invoices FROM b x JOIN b y "
                   "ON x.InvoiceNo = y.InvoiceNo AND x.StockCode < y.StockCode GROUP BY ALL HAVING count(*) >= 2) "
                   "SELECT item_a, item_b, invoices, invoices / t.n AS support, invoices / ia.n AS confidence_a_to_b, "
                   "invoices / ib.n AS confidence_b_to_a, invoices * t.n / (ia.n * ib.n) AS lift "
                   "FROM p JOIN i ia ON ia.StockCode = item_a JOIN i ib ON ib.StockCode = item_b CROSS JOIN t)"),
        ["support", "confidence_a_to_b", "confidence_b_to_a", "lift"], "E15")
    q["amount_quantile_error"] = Query(
        amount_quantile_error_df,
        w("clean", "SELECT Country, CAST(percent AS INTEGER) AS percent, count(*) AS amounts, true AS within_one_percent "
                   "FROM v CROSS JOIN (SELECT unnest([20, 50, 80]) AS percent) WHERE total_price IS NOT NULL GROUP BY ALL"),
        [], "D14 approximate")
    q["monthly_distinct"] = Query(
        lambda s, d: SK.monthly_distinct(SK.daily_sketches(clean_df(s, d))),
        w("clean", "SELECT year, month, count(DISTINCT CustomerID) AS distinct_customers, count(DISTINCT StockCode) AS distinct_products, "
                   "count(DISTINCT CustomerID) FILTER (WHERE EXISTS (SELECT 1 FROM v e WHERE e.CustomerID = v.CustomerID "
                   "AND e.year * 12 + e.month + 1 = v.year * 12 + v.month)) AS returning_customers FROM v GROUP BY year, month"),
        [], "D8 D17 D22 E6 distinct")
    q["transaction_features"] = Query(
        transaction_features_df,
        w("tf", "SELECT * FROM tf"), TF_DOUBLES, "E23-E27")

    # ---- segmentation
    profiles = ("SELECT segment_name, count(CustomerID) AS customer_count, avg(recency_days) AS avg_recency_days, "
                "avg(frequency) AS avg_frequency, avg(monetary) AS avg_monetary, "
                "avg(avg_transaction_value) AS avg_transaction_value, avg(unique_products) AS avg_unique_products, "
                "avg(engagement_score_fe) AS avg_engagement_score_fe FROM {} GROUP BY segment_name")
    summary = (f"SELECT segment_name, count(*) AS customer_count, {O.r('sum(monetary)')} AS total_revenue, "
               f"{O.r('avg(frequency)')} AS avg_frequency FROM {{}} GROUP BY segment_name")
    names = "SELECT DISTINCT segment_name FROM {}"
    detail = (f"SELECT segment_name, count(*) AS customer_count, {O.r('avg(recency_days)')} AS avg_recency, "
              f"{O.r('avg(frequency)')} AS avg_frequency, {O.r('avg(monetary)')} AS avg_monetary, "
              f"{O.r('sum(monetary)')} AS total_revenue FROM {{}} WHERE segment_name = '{SHOWN_SEGMENT}' GROUP BY segment_name")
    customer = ("SELECT CustomerID AS customer_id, segment_name, cluster_id, recency_days, frequency, "
                f"{O.r('monetary')} AS monetary, {O.r('s.avg_transaction_value')} AS avg_transaction_value FROM {{}} s "
                "WHERE CustomerID = 1 ORDER BY cluster_id, s.avg_transaction_value, segment_name LIMIT 1")
    q["prepared_features"] = Query(
        lambda s, d: SG.prepare_features(cf_df(s, d)),
        w("cf", "SELECT * FROM cf WHERE frequency > 0 AND monetary > 0"), CF_DOUBLES, "F1")
    q["k_sweep"] = Query(
        lambda s, d: SG.k_sweep(materialize(SG.prepare_features(cf_df(s, d)), "prepared")),
        w("ksweep", "SELECT * FROM ksweep"), ["cost", "silhouette", "chord_gap"], "F2-F4")
    q["customer_segments"] = Query(
        segments_df, w("ksegs", "SELECT * FROM ksegs"), SEGMENT_DOUBLES, "F5-F9 F11")
    q["segment_profiles"] = Query(
        lambda s, d: SG.segment_profiles(segmented_df(s, d)), w("ksegs", profiles.format("ksegs")), PROFILE_DOUBLES, "F10")

    # the same operators over documented centres, which SQL reproduces
    q["scaled_features"] = Query(
        lambda s, d: scaled_df(s, d).select("CustomerID", "Country", *[f"{c}_scaled" for c in SG.FEATURE_COLUMNS]),
        w("cf", f"SELECT CustomerID, Country, {O.scaled_columns(SG.FEATURE_COLUMNS)} FROM cf WHERE frequency > 0 AND monetary > 0"),
        [f"{c}_scaled" for c in SG.FEATURE_COLUMNS], "F2 F3")
    q["centre_segments"] = Query(
        centre_segments_df, w("csegs", "SELECT * FROM csegs"),
        SEGMENT_DOUBLES, "F6-F9 F11")
    q["centre_profiles"] = Query(
        lambda s, d: SG.segment_profiles(centre_segmented_df(s, d)), w("csegs", profiles.format("csegs")), PROFILE_DOUBLES, "F10")

    # lookups over the segments of the fitted clusters and of the documented centres
    for layer, prefix, source in (("ksegs", "", segments_df), ("csegs", "centre_", centre_segments_df)):
        q[f"{prefix}segments_summary"] = Query(
            lambda s, d, f=source: SV.segments_summary(f(s, d)), w(layer, summary.format(layer)),
            ["total_revenue", "avg_frequency"], "G3")
        q["centre_segment_names" if prefix else "list_segments"] = Query(
            lambda s, d, f=source: SV.list_segments(f(s, d)), w(layer, names.format(layer)), [], "G4")
        q[f"{prefix}segment_detail"] = Query(
            lambda s, d, f=source: SV.segment_detail(f(s, d), SHOWN_SEGMENT), w(layer, detail.format(layer)),
            ["avg_recency", "avg_frequency", "avg_monetary", "total_revenue"], "G5")
        q[f"{prefix}customer_segment"] = Query(
            lambda s, d, f=source: SV.customer_segment(f(s, d), 1), w(layer, customer.format(layer)),
            ["monetary", "avg_transaction_value"], "G6")

    # ---- serving
    q["customer_overview"] = Query(
        lambda s, d: SV.customer_overview(c360_df(s, d)),
        w("c360", "SELECT count(*) AS total_customers, count(DISTINCT CustomerID) AS distinct_customers, "
                  "count(*) FILTER (WHERE recency_days <= 90) AS active_customers, "
                  f"{O.r('coalesce(sum(monetary), 0)')} AS total_revenue, "
                  f"{O.r('coalesce(avg(monetary), 0)')} AS avg_customer_value FROM c360"),
        ["total_revenue", "avg_customer_value"], "G1")
    q["product_overview"] = Query(
        lambda s, d: SV.product_overview(pm_df(s, d)),
        w("pm", "SELECT count(*) AS total_products, CAST(coalesce(sum(times_purchased), 0) AS BIGINT) AS total_transactions, "
                f"{O.r('coalesce(avg(avg_price), 0)')} AS avg_product_price FROM pm"),
        ["avg_product_price"], "G2")
    q["revenue_trends"] = Query(
        lambda s, d: SV.revenue_trends(G.daily_aggregates(clean_df(s, d))),
        w("daily", "SELECT date, sum(total_revenue) AS total_revenue, "
                   "CAST(sum(total_transactions) AS BIGINT) AS total_transactions, "
                   "CAST(sum(total_items_sold) AS BIGINT) AS total_items_sold, count(*) AS countries "
                   "FROM daily GROUP BY date"),
        ["total_revenue"], "G7")
    return q


REGISTRY = _registry()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.spark for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.oracle() for name, q in REGISTRY.items() if q.sql is not None}
