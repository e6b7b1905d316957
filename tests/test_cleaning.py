"""Column functions and the clean step on hand-written rows (FIXTURES §3)."""

from __future__ import annotations

import datetime as dt

from helpers import clean_of, line, raw_df
from tillroll.functions import columns as C
from tillroll.operators import bronze as B
from tillroll.operators import silver as S


def test_bad_dates_become_null_and_are_dropped(spark):
    rows = [line(date="12/1/2010 8:26"), line(inv="2", date="2010-12-01"),
            line(inv="3", date=None), line(inv="4", date="")]
    df = raw_df(spark, rows).select(C.parse_invoice_ts("InvoiceDate").alias("ts"))
    got = [r.ts for r in df.collect()]
    assert got[0] == dt.datetime(2010, 12, 1, 8, 26)
    assert got[1:] == [None, None, None]
    assert clean_of(spark, rows).count() == 1


def test_guest_ids_never_become_zero(spark):
    df = spark.createDataFrame(
        [(None,), ("17850",), ("17850.0",), ("NaN",), ("abc",)], "CustomerID string"
    ).select(C.customer_to_int().alias("c"))
    assert [r.c for r in df.collect()] == [None, 17850, 17850, None, None]
    nan = spark.createDataFrame([(float("nan"),), (12.0,)], "CustomerID double")
    assert [r.c for r in nan.select(C.customer_to_int().alias("c")).collect()] == [None, 12]


def test_null_flags_are_false_and_rows_kept(spark):
    rows = [line(inv=None, qty=0, price=0.0)]
    out = clean_of(spark, rows).collect()
    assert len(out) == 1
    assert out[0].is_return is False and out[0].is_cancellation is False
    assert out[0].total_price == 0.0


def test_negative_price_and_null_quantity_dropped(spark):
    rows = [line(price=-1.0), line(inv="2", qty=None), line(inv="3", price=None), line(inv="4")]
    assert [r.InvoiceNo for r in clean_of(spark, rows).collect()] == ["4"]


def test_text_normalisation(spark):
    out = clean_of(spark, [line(code=" ab1 ", desc=None, country=" France ")]).collect()[0]
    assert (out.StockCode, out.Description, out.Country) == ("AB1", "UNKNOWN", "France")


def test_calendar_and_flags(spark):
    # 2010-12-04 is a Saturday; C prefix = cancellation; negative = return
    out = clean_of(spark, [line(inv="C9", qty=-2, date="12/4/2010 23:05")]).collect()[0]
    assert (out.year, out.month, out.day, out.day_of_week, out.hour, out.quarter) == (2010, 12, 4, 7, 23, 4)
    assert out.is_weekend and out.is_return and out.is_cancellation
    assert out.total_price == -4.0


def test_duplicate_lines_keep_one_stable_survivor(spark):
    rows = [line(qty=5), line(qty=3), line(qty=3, desc="other")]
    first = clean_of(spark, rows).collect()
    again = clean_of(spark, list(reversed(rows))).collect()
    assert len(first) == 1
    assert (first[0].Quantity, first[0].Description) == (3, "other")
    assert first == again


def test_dedup_prefers_newest_load(spark):
    old = B.add_lineage(raw_df(spark, [line(qty=1)]), ingested_at="2010-01-01 00:00:00")
    new = B.add_lineage(raw_df(spark, [line(qty=9)]), ingested_at="2011-01-01 00:00:00")
    out = S.clean_transactions(old.unionByName(new)).collect()
    assert [r.Quantity for r in out] == [9]


def test_record_hash_matches_sha256_of_joined_text(spark):
    import hashlib

    df = B.add_lineage(raw_df(spark, [line(inv="536365", code="85123A", date="12/1/2010 8:26")]))
    got = df.select("record_hash").collect()[0][0]
    assert got == hashlib.sha256(b"536365|85123A|12/1/2010 8:26").hexdigest()
    # NULL parts are skipped, as concat_ws does
    df2 = B.add_lineage(raw_df(spark, [line(inv=None, code="X", date="1/1/2011 0:00")]))
    assert df2.select("record_hash").collect()[0][0] == hashlib.sha256(b"X|1/1/2011 0:00").hexdigest()


def test_hour_flags(spark):
    from tillroll.operators.features import transaction_features

    hours = [6, 7, 9, 17, 18, 21, 22]
    rows = [line(inv=str(i), date=f"12/1/2010 {h}:00") for i, h in enumerate(hours)]
    out = {r.hour: (r.is_business_hours, r.is_night_purchase)
           for r in transaction_features(clean_of(spark, rows)).collect()}
    assert out == {6: (0, 1), 7: (0, 0), 9: (1, 0), 17: (1, 0), 18: (0, 0), 21: (0, 0), 22: (0, 1)}


def test_quality_and_ranges(spark):
    rows = [line(), line(inv="C2", qty=-1), line(inv="3", cust=None, price=4.0)]
    clean = clean_of(spark, rows)
    q = S.silver_quality(clean).collect()[0]
    assert (q.total_records, q.returns, q.cancellations, q.valid_customers) == (3, 1, 1, 2)
    assert q.returns_pct == 33.33
    bq = B.bronze_quality(B.add_lineage(raw_df(spark, rows))).collect()[0]
    assert (bq.total_rows, bq.null_customers, bq.negative_quantities) == (3, 1, 1)
    ps = S.silver_price_stats(clean).collect()[0]
    assert (ps.min_total_price, ps.max_total_price) == (2.0, 4.0)


def test_empty_input_everywhere(spark):
    from tillroll.operators import features as FE
    from tillroll.operators import gold as G
    from tillroll.operators import serving as SV

    clean = clean_of(spark, [line(date="bad")])
    assert clean.count() == 0
    assert G.customer_360(clean, as_of="2011-01-01").count() == 0
    assert G.product_metrics(clean).count() == 0
    assert G.daily_aggregates(clean).count() == 0
    assert G.country_analytics(clean).count() == 0
    assert FE.customer_features(clean, as_of="2011-01-01").count() == 0
    assert FE.transaction_features(clean).count() == 0
    ov = SV.customer_overview(G.customer_360(clean)).collect()[0]
    assert (ov.total_customers, ov.total_revenue) == (0, 0.0)
    assert S.silver_quality(clean).collect()[0].total_records == 0


def test_ingest_transactions_from_csv(spark):
    import os
    import tempfile

    from tillroll.sources.io import read_table

    tmp = tempfile.mkdtemp(prefix="tillroll-ingest-")
    src = os.path.join(tmp, "raw")
    raw_df(spark, [line(), line(inv="2", cust=None)]).write.option("header", "true").csv(src)
    B.ingest_transactions(spark, src, os.path.join(tmp, "lake"), fmt="csv",
                          ingested_at="2011-01-01 00:00:00")
    bronze = read_table(spark, os.path.join(tmp, "lake"), "bronze", "transactions")
    assert bronze.columns == [*S.BRONZE_COLUMNS, "_corrupt_record"]
    assert bronze.count() == 2
