"""Load-by-load refresh: equal to the full rebuild, and what a load reads and leaves."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import INGESTED, clean_of, line, raw_df
from tillroll.operators import bronze as B
from tillroll.operators import features as FE
from tillroll.operators import gold as G
from tillroll.operators import silver as S
from tillroll.plans import refresh as RF
from tillroll.sources import versions
from tillroll.sources.io import read_table, table_path

AS_OF = "2011-12-31"


def month_lines(month, n, year=2011):
    return [line(inv=f"{month}{i:03d}", code=f"S{i % 5}", desc=None if i % 4 == 0 else f"thing {i % 3}", qty=1 + i % 6 if i % 9 else -2,
                 date=f"{month}/{1 + i % 27}/{year} 8:0{i % 10}", price=0.5 + i % 7, cust=None if i % 8 == 0 else str(i % 11),
                 country=["UK", "France", "EIRE"][i % 3]) for i in range(n)]


def rows(df):
    shown = df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    return sorted(map(str, (tuple(r) for r in shown.collect())))


def full(spark, lines):
    clean = clean_of(spark, lines)
    return {"customer_360": G.customer_360(clean, as_of=AS_OF), "product_metrics": G.product_metrics(clean),
            "daily_aggregates": G.daily_aggregates(clean), "country_analytics": G.country_analytics(clean)}


def load(spark, base, lines):
    return RF.refresh(spark, base, raw_df(spark, lines), as_of=AS_OF, ingested_at=INGESTED, source_name="t")


@pytest.fixture()
def three_months():
    return month_lines(1, 60) + month_lines(2, 50) + month_lines(3, 40)


def test_loads_equal_the_rebuild(spark, tmp_path, three_months):
    base, march = str(tmp_path), month_lines(3, 40)
    held = table_path(base, "silver", "lines_by_month")
    assert load(spark, base, month_lines(1, 60) + month_lines(2, 50) + march[:15]) == [(2011, 1), (2011, 2), (2011, 3)]
    before = versions.current(spark, held)
    assert load(spark, base, march[10:] + march[12:20]) == [(2011, 3)]  # some lines come again
    after = versions.current(spark, held)
    assert {p for p in before if before[p] == after[p]} == {"year=2011/month=1", "year=2011/month=2"}
    for name, want in full(spark, three_months).items():
        assert rows(read_table(spark, base, "gold", name, columns=want.columns)) == rows(want), name
    assert load(spark, base, march[10:]) == [(2011, 3)] and load(spark, base, []) == []  # repeated and empty loads
    for name, want in full(spark, three_months).items():
        assert rows(read_table(spark, base, "gold", name, columns=want.columns)) == rows(want), name


def test_a_load_reads_touched_months_only(spark, tmp_path, three_months):
    base = str(tmp_path)
    load(spark, base, three_months)
    held = table_path(base, "silver", "lines_by_month")
    march = versions.read_current(spark, held, partitions=["year=2011/month=3"])
    assert march.count() == 40 and all("month=3" in f for f in march.inputFiles())
    lines = {f for f in versions.read_current(spark, held).inputFiles()}
    for mart in RF.marts(spark, base, AS_OF).values():
        assert not lines & set(mart.inputFiles())


def test_newer_copies_replace_older_ones(spark, tmp_path):
    base = str(tmp_path)
    old, new = line(inv="1", qty=1, price=2.0), line(inv="1", qty=5, price=3.0)
    bronze = [B.add_lineage(raw_df(spark, [r]), ingested_at=t, source_file="t") for r, t in ((old, "2011-01-01"), (new, "2011-01-02"))]
    RF.add_load(bronze[0], base)
    RF.add_load(bronze[1], base)
    got = RF.marts(spark, base, AS_OF)["product_metrics"].first()
    assert got.total_revenue == 15.0 and got.min_price == 3.0
    RF.add_load(bronze[0], base)  # the older copy comes late
    assert RF.marts(spark, base, AS_OF)["product_metrics"].first().total_revenue == 15.0


def test_merged_moments(spark, tmp_path, three_months):
    parts = G.product_line_stats(clean_of(spark, three_months), by=RF.MONTH).drop(*RF.MONTH)
    whole = G.product_line_stats(clean_of(spark, three_months))
    assert rows(FE.product_popularity(RF.merge_products(parts))) == rows(FE.product_popularity(whole))


def odd_bronze(spark, lines):
    bronze = B.add_lineage(raw_df(spark, lines + lines[:7] + [line(inv=None, code=" a1 "), line(code=None)]), ingested_at=INGESTED, source_file="t")
    foreign = F.when(F.col("CustomerID") == "3", F.lit(None)).when(F.col("CustomerID") == "4", F.concat(F.lit("k"), "record_hash"))
    return bronze.withColumn("record_hash", F.when(F.col("CustomerID").isin("3", "4"), foreign).otherwise(F.col("record_hash")))


def test_only_lines_that_may_be_copies_are_shuffled(spark, three_months):
    for raw_code in ([], [S.raw_code_column()]):
        parsed = S.parse_and_validate(odd_bronze(spark, three_months), raw_code)
        want = rows(RF.latest_by_month(S.parse_and_validate(odd_bronze(spark, three_months))))
        for few in (S.FEW_REPEATED, 0):
            latest = RF.latest_of_load(parsed, few)
            assert rows(latest.drop(S.RAW_CODE)) == want
    single, repeated = S.split_repeated(S.parse_and_validate(odd_bronze(spark, three_months)))
    again = {r.record_hash for r in single.collect()} & {r.record_hash for r in repeated.collect()}
    assert not again and 14 <= repeated.count() < single.count()


def test_stored_lines_hold_no_hash_that_their_columns_give(spark, tmp_path, three_months):
    base, bronze = str(tmp_path), odd_bronze(spark, three_months)
    held = table_path(base, "silver", "lines_by_month")
    touched = RF.add_load(bronze, base)
    want = rows(RF.latest_by_month(S.parse_and_validate(bronze)))
    for _ in range(2):  # the load comes again
        stored = versions.read_current(spark, held)
        assert stored.where("record_hash IS NOT NULL AND record_hash NOT LIKE 'k%'").count() < 5 < stored.where("record_hash IS NULL").count()
        assert rows(RF.stored_lines(spark, base, touched).drop(S.RAW_CODE)) == want
        RF.add_load(bronze, base)


def test_loads_with_all_hashes_are_still_read(spark, tmp_path):
    base, bronze = str(tmp_path), B.add_lineage(raw_df(spark, month_lines(1, 30) + month_lines(2, 20)), ingested_at=INGESTED, source_file="t")
    versions.replace_partitions(S.clean_transactions(bronze), table_path(base, "silver", "lines_by_month"), RF.MONTH, [(2011, 1), (2011, 2)])
    more = B.add_lineage(raw_df(spark, month_lines(2, 25)), ingested_at=INGESTED, source_file="t")
    assert RF.add_load(more, base) == [(2011, 2)]
    whole = B.add_lineage(raw_df(spark, month_lines(1, 30) + month_lines(2, 25)), ingested_at=INGESTED, source_file="t")
    got = RF.stored_lines(spark, base, [(2011, 1), (2011, 2)]).drop(S.RAW_CODE)
    assert rows(got) == rows(S.clean_transactions(whole))


def test_parts_leave_out_what_they_can_give(spark):
    clean = clean_of(spark, [line(inv="1", code="A", price=0.1, qty=3), line(inv="2", code="B", price=2.5), line(inv="3", code="B", price=3.5, qty=2)])
    parts = RF.product_parts(clean)
    held = {r.StockCode: (r.min_price, r.max_price, r.total_revenue) for r in parts.collect()}
    assert held == {"A": (None, None, None), "B": (2.5, 3.5, 9.5)}
    columns = G.product_line_stats(clean).columns
    assert rows(RF.merge_products(parts.drop(*RF.MONTH)).select(*columns)) == rows(G.product_line_stats(clean))
