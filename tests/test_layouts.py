"""Bucketed lines, lookup tables, hot customers, baskets and sketches."""

from __future__ import annotations

import glob
from collections import Counter, defaultdict
from itertools import combinations
from statistics import median

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, clean_of, line
from tillroll.operators import baskets as BK
from tillroll.operators import features as FE
from tillroll.operators import gold as G
from tillroll.operators import serving as SV
from tillroll.operators import sketches as SK
from tillroll.operators.silver import valid_sales
from tillroll.plans.registry import clean_df
from tillroll.session import materialize
from tillroll.sources import layouts as LY


@pytest.fixture(scope="module")
def clean(spark):
    return materialize(clean_df(spark, SF_SMALL), "layout_clean")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    shown = df.select(*[F.round(F.col(c) + 3.7e-9, 4).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)])
    return sorted(map(str, map(tuple, shown.collect())))


# ------------------------------------------------------------ bucketed lines

def test_bucketed_lines_need_no_exchange(spark, clean, tmp_path):
    path = str(tmp_path / "lines")
    both = LY.write_bucketed(clean, "lines_by_customer", path)
    try:
        assert rows(both) == rows(clean)
        known = LY.known_lines(spark, "lines_by_customer")
        sales = valid_sales(known, known_customer=True)
        for df in (G.customer_country_stats(known), FE.customer_line_features(sales, as_of="2001-08-01"),
                   FE.purchase_gap_features(sales), FE.customer_price_stats(known), FE.known_transaction_features(known)):
            assert "Exchange" not in plan_of(df)
        wide = FE.customer_line_features(sales, as_of="2001-08-01")
        assert rows(wide) == rows(FE.customer_line_features(valid_sales(clean, known_customer=True), as_of="2001-08-01"))
        tf = FE.transaction_features(clean)
        assert rows(FE.known_transaction_features(known)) == rows(tf.where("CustomerID IS NOT NULL"))
        # another session's catalog learns of the stored table
        LY.register_bucketed(spark, "lines_again", path, clean.where("CustomerID IS NOT NULL"))
        again = LY.known_lines(spark, "lines_again")
        assert rows(again) == rows(known) and "Exchange" not in plan_of(FE.customer_price_stats(again))
    finally:
        for name in ("lines_by_customer", "lines_again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# ------------------------------------------------------------- lookup tables

def scan_rows(df):
    """Rows that the scan of a collected query gave."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value()


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    path = str(tmp_path / "segments")
    wide = spark.range(0, 60_000, 1, 4).select(
        (F.col("id") * 3).alias("CustomerID"), F.sha2(F.col("id").cast("string"), 256).alias("segment_name"),
        (F.col("id") % 5).cast("int").alias("cluster_id"), F.lit(1).alias("recency_days"), F.lit(2).alias("frequency"),
        F.rand(1).alias("monetary"), F.rand(2).alias("avg_transaction_value"))
    LY.write_lookup(wide, path, "CustomerID", row_group_bytes=1 << 16)
    groups, held = 0, 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            at = meta.row_group(g).column(0)
            groups += 1
            held += at.statistics.min <= 90_000 <= at.statistics.max
    assert groups > 20 and held == 1
    got = LY.lookup(spark, path, "CustomerID", 90_000)
    assert got.count() == 1 and scan_rows(got) < 60_000 / 10
    assert "PushedFilters: [IsNotNull(CustomerID), EqualTo(CustomerID,90000)]" in plan_of(got)
    # a key that lies between the others: the Bloom filter leaves nothing to read
    assert scan_rows(LY.lookup(spark, path, "CustomerID", 90_001)) == 0
    assert SV.customer_segment(spark.read.parquet(path), 90_000).first().customer_id == 90_000


# ------------------------------------------------------------- hot customers

def test_hot_customers_are_spread(spark):
    lines = [line(inv=str(i), code=f"P{i % 9}", cust="1" if i % 3 == 0 else str(2 + i % 1500), price=1.0 + i % 7) for i in range(6000)]
    clean = materialize(clean_of(spark, lines), "hot_lines")
    hot = [r.CustomerID for r in FE.hot_customers(clean).collect()]
    assert hot == [1]
    salted = clean.select(FE.guest_salted_key().alias("k"), F.when(F.col("CustomerID") == 1, F.pmod(F.xxhash64("record_hash"), F.lit(FE.HOT_SALTS))).otherwise(0).alias("s"))
    sizes = [r["count"] for r in salted.repartition(16, "k", "s").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * median(sizes)
    tf = FE.transaction_features(clean)
    assert tf.count() == clean.count() and tf.where("customer_avg_price IS NULL").count() == 0
    assert rows(tf) == rows(FE.transaction_features(clean, hot_share=1.0))  # nobody is hot
    assert rows(tf) == rows(FE.transaction_features(clean, hot_share=1 / 5000, salts=3))


# -------------------------------------------------------------------- baskets

def brute_pairs(clean, least):
    held = defaultdict(set)
    for r in valid_sales(clean).collect():
        held[r.InvoiceNo].add(r.StockCode)
    n = len(held)
    single = Counter(i for items in held.values() for i in items)
    pairs = Counter(p for items in held.values() for p in combinations(sorted(items), 2))
    return {(a, b, c, round(c / n, 9), round(c / single[a], 9), round(c / single[b], 9), round(c * n / (single[a] * single[b]), 9))
            for (a, b), c in pairs.items() if c >= least}


@pytest.mark.parametrize("block_items", [256, 7])
def test_pairs_of_small_and_huge_invoices(spark, block_items):
    lines = [line(inv="HUGE", code=f"P{i:03d}") for i in range(90)] + [line(inv="HUGE", code="P001", qty=2)]
    lines += [line(inv=str(i), code=f"P{(i * j) % 40:03d}", qty=-1 if i % 11 == 0 else 1) for i in range(60) for j in range(1, 6)]
    lines += [line(inv="C9", code="P001"), line(inv="alone", code="ONLY")]
    clean = clean_of(spark, [(*r[:4], f"12/{1 + i % 28}/2010 {i % 24}:{i % 60:02d}", *r[5:]) for i, r in enumerate(lines)])
    for least in (2, 3):
        got = BK.item_pairs(clean, min_invoices=least, block_items=block_items).collect()
        assert {(*r[:3], *(round(x, 9) for x in r[3:])) for r in got} == brute_pairs(clean, least)
    assert BK.item_pairs(clean_of(spark, []), 2).count() == 0


def test_frequent_items_are_cut_first(spark, clean):
    kept = BK.paired(FE.basket_items(clean).select("InvoiceNo", "StockCode").limit(0))
    assert kept.count() == 0
    plan = plan_of(BK.item_pairs(clean, 2))
    assert "CartesianProduct" not in plan and "item_invoices" not in plan.split("SortMergeJoin")[-1].split("Scan")[0]


# ------------------------------------------------------------------- sketches

def test_quantiles_under_ties_and_skew(spark):
    lines = [line(inv=str(i), code=f"P{i}", qty=1, price=5.0 if i % 2 else float(i), country="UK" if i % 3 else "FR",
                  date=f"{1 + i % 12}/{1 + i % 28}/2011 8:00") for i in range(4000)]
    clean = materialize(clean_of(spark, lines), "tied")
    stored = materialize(SK.daily_sketches(clean), "tied-sketches")
    for by in (["Country"], ["month"]):
        shown = clean.withColumn("month", F.month("invoice_datetime"))
        q = SK.amount_quantiles(stored.withColumn("month", F.month("date")), by, [1, 20, 50, 80, 99])
        for r in SK.amount_bands(shown, q, by[0]).collect():
            assert r.below <= r.percent / 100 + 0.01 and r.up_to >= r.percent / 100 - 0.01


def test_distinct_counts_from_merged_sketches(spark):
    big = spark.range(0, 200_000, 1, 4).select(
        (F.col("id") % 60_000).cast("int").alias("CustomerID"), F.concat(F.lit("P"), F.col("id") % 300).alias("StockCode"),
        F.lit("UK").alias("Country"), F.lit(False).alias("is_return"), F.lit(False).alias("is_cancellation"), F.lit(1.0).alias("total_price"),
        F.timestamp_add("DAY", (F.col("id") % 62).cast("int"), F.lit("2011-01-01").cast("timestamp")).alias("invoice_datetime"))
    stored = materialize(SK.daily_sketches(big), "big-sketches")
    got = {(r.year, r.month): r for r in SK.monthly_distinct(stored).collect()}
    months = big.withColumn("month", F.month("invoice_datetime"))
    exact = {r.month: r for r in months.groupBy("month").agg(F.count_distinct("CustomerID").alias("c"), F.count_distinct("StockCode").alias("p")).collect()}
    for (_, m), r in got.items():
        assert abs(r.distinct_customers / exact[m].c - 1) < 0.03 and r.distinct_products == exact[m].p
    jan, feb = (months.where(f"month = {m}").select("CustomerID").distinct() for m in (1, 2))
    assert abs(got[2011, 2].returning_customers / jan.intersect(feb).count() - 1) < 0.06
    assert got[2011, 1].returning_customers == 0
