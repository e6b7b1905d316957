"""Feature tables: gap statistics, guards, z-scores, baskets."""

from __future__ import annotations

from helpers import SF_SMALL, clean_of, line
from tillroll.operators import features as FE
from tillroll.operators.silver import valid_sales
from tillroll.plans.registry import clean_df


def test_gap_std_is_null_below_two_gaps(spark):
    rows = [line(inv="1", cust="1"), line(inv="2", cust="2"), line(inv="3", cust="2", date="12/5/2010 8:26")]
    rows += [line(inv=str(10 + i), cust="3", date=f"12/{d}/2010 8:26") for i, d in enumerate((1, 3, 9))]
    vk = valid_sales(clean_of(spark, rows), known_customer=True)
    got = {r.CustomerID: r for r in FE.purchase_gap_features(vk).collect()}
    assert got[1].std_days_between_purchases is None and got[1].avg_days_between_purchases_fe is None
    assert got[2].std_days_between_purchases is None and got[2].avg_days_between_purchases_fe == 4.0
    assert abs(got[3].std_days_between_purchases - 8 ** 0.5) < 1e-12


def test_same_time_lines_have_zero_gaps(spark):
    rows = [line(inv=str(i), code=f"P{i}") for i in range(3)] + [
        line(inv="9", date="12/11/2010 8:26")]
    cf = FE.customer_features(clean_of(spark, rows), as_of="2010-12-31").collect()[0]
    # gaps: 0, 0, 10 -> avg 10/3, min 0, max 10
    assert cf.min_days_between_purchases == 0 and cf.max_days_between_purchases == 10
    assert abs(cf.avg_days_between_purchases_fe - 10 / 3) < 1e-12
    assert abs(cf.std_days_between_purchases - (100 / 3) ** 0.5) < 1e-12


def test_single_row_customer_fills_zero(spark):
    cf = FE.customer_features(clean_of(spark, [line()]), as_of="2010-12-31").collect()[0]
    assert cf.std_transaction_value == 0.0 and cf.std_purchase_hour == 0.0
    assert cf.avg_days_between_purchases_fe == 0.0 and cf.min_days_between_purchases == 0
    assert cf.spending_consistency == 0.0 and cf.purchase_regularity == 0.0
    assert cf.engagement_score_fe == 0.0 and cf.recency_to_age_ratio == 0.0
    assert cf.customer_segment is not None  # text columns are not filled


def test_spending_windows_are_relative_to_as_of(spark):
    rows = [line(inv="1", date="12/25/2010 8:00", price=10.0),
            line(inv="2", date="11/1/2010 8:00", price=5.0),
            line(inv="3", date="6/1/2010 8:00", price=1.0)]
    cf = FE.customer_features(clean_of(spark, rows), as_of="2010-12-31").collect()[0]
    assert (cf.spending_last_30_days, cf.spending_last_90_days) == (10.0, 15.0)
    assert cf.spending_trend_30_vs_90 == 10.0 / 15.0
    assert cf.unique_stock_codes == 1 and cf.product_variety == 3


def test_price_tiers(spark):
    df = spark.createDataFrame([(4.99,), (5.0,), (9.99,), (10.0,)], "avg_transaction_value double")
    got = [r.t for r in df.select(FE.price_tier().alias("t")).collect()]
    assert got == ["Budget", "Mid-Range", "Mid-Range", "Premium"]


def test_zscores_guests_and_single_lines(spark):
    rows = [line(inv="1", price=1.0), line(inv="2", price=3.0),
            line(inv="3", cust=None, price=100.0), line(inv="4", cust="9", price=7.0)]
    tf = {r.InvoiceNo: r for r in FE.transaction_features(clean_of(spark, rows)).collect()}
    assert tf.keys() == {"1", "2", "3", "4"}
    assert abs(tf["1"].price_zscore + 0.7071067811865475) < 1e-12
    assert tf["3"].customer_avg_price is None and tf["3"].price_zscore == 0.0
    assert tf["4"].customer_std_price is None and tf["4"].price_zscore == 0.0
    assert len(FE.TRANSACTION_FEATURE_COLUMNS) == 31


def test_baskets_long_form(spark):
    rows = [line(inv="1", code="B"), line(inv="1", code="A", qty=2),
            line(inv="1", code="B", date="12/1/2010 9:00"), line(inv="2", code="C")]
    clean = clean_of(spark, rows)
    items = sorted(tuple(r) for r in FE.basket_items(clean).collect())
    assert items == [("1", "A", 1), ("1", "B", 2), ("2", "C", 1)]


def test_product_features_schema(spark):
    pf = FE.product_features(clean_df(spark, SF_SMALL))
    assert len(pf.columns) == 24
    assert pf.where("price_tier IS NULL OR popularity_score IS NULL").count() == 0
