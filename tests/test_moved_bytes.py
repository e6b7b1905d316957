"""What the steps that move every line carry, and that it comes back whole."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from helpers import INGESTED, SF_SMALL, clean_of, line, raw_df
from tillroll.operators import bronze as B
from tillroll.operators import features as FE
from tillroll.operators import silver as S
from tillroll.plans import refresh as RF
from tillroll.plans.registry import clean_df
from tillroll.session import materialize
from tillroll.sources.tables import raw_invoice_lines


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hashes_are_packed_for_the_shuffle_and_come_back(spark):
    odd = [None, "", "abc", "é" * 7, "x" * 31, "x" * 32, "x" * 33, "A" * 64, "g" * 64, "0" * 63 + "\n", "0" * 64, hashlib.sha256(b"a").hexdigest()]
    df = spark.createDataFrame([(h,) for h in odd], "record_hash string")
    packed = df.select("record_hash", S.packed_hash().alias("p"))
    assert packed.select("p").distinct().count() == len(odd)
    back = packed.select("record_hash", F.col("p"), S.unpacked_hash("p").alias("b"), F.octet_length("p").alias("n")).collect()
    assert [r.b for r in back] == [r.record_hash for r in back]
    assert back[-1].n == 33
    plan = plan_of(clean_df(spark, SF_SMALL))
    assert "unhex" in plan[plan.index("Exchange hashpartitioning(record_hash"):]  # packed before, not after


def test_raw_lines_carry_keys_not_texts(spark):
    above = plan_of(raw_invoice_lines(spark, SF_SMALL)).split("Exchange hashpartitioning")[0]
    assert "n_name" in above and "l_returnflag" not in above and "l_suppkey" not in above and "l_linenumber" not in above


def test_a_customers_lines_are_stored_together(spark):
    rows = [line(inv=str(i), code=f"P{i % 7}", qty=1 + i % 4, date=f"11/{1 + i % 28}/2010 9:00", cust=None if i % 10 == 0 else str(i % 50),
                 desc=None if i % 3 else "x", country="UK" if i % 3 else "FR") for i in range(2000)]
    rows += [line(inv=None, cust="7"), line(inv="C1", cust="7"), line(inv="2", qty=-1, cust="7")]
    clean = clean_of(spark, rows).repartition(16)
    stored = FE.customer_lines(clean)
    assert "Country" in stored.columns and "record_hash" not in stored.columns
    assert stored.select("CustomerID", F.input_file_name()).distinct().count() == stored.select("CustomerID").distinct().count()
    want, got = (FE.customer_features(x, as_of="2010-12-31") for x in (clean, stored))
    shown = lambda df: sorted(map(str, df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))
    assert shown(got) == shown(want)


def odd_lines():
    rows = [*lines_by_month(150), *lines_by_month(30)] + [line(inv="9", qty=q, desc=d) for q, d in ((5, "a"), (3, "b"), (3, "a"), (-1, None))]
    rows += [line(inv=i, cust="7", qty=q) for i in (None, "", "C1", "c1", "C") for q in (1, 2)]
    return rows + [line(inv=None, code=None, desc=None, cust="8"), line(inv=None, code=None), line(date="bad")]


def test_lean_lines_are_the_clean_ones(spark):
    bronze = B.add_lineage(raw_df(spark, odd_lines()), ingested_at=INGESTED, source_file="t")
    same = [c for c in S.SILVER_COLUMNS if c not in ("record_hash", "InvoiceNo")]
    lines = lambda df: sorted(map(str, df.select(*same, F.col("InvoiceNo").isNull()).collect()))
    clean, lean = S.clean_transactions(bronze), S.lean_clean(bronze)
    assert lines(lean) == lines(clean)
    assert {r.InvoiceNo for r in lean.collect()} == {None, "", "C"}
    other = bronze.withColumn("record_hash", F.concat(F.lit("k"), F.col("InvoiceNo"), F.lit("é" * 40), F.col("StockCode")))  # no hex
    assert lines(S.lean_clean(other)) == lines(S.clean_transactions(other))


def test_customer_lines_shuffle_no_flags_or_calendar(spark):
    lean = S.lean_clean(B.add_lineage(raw_df(spark, odd_lines()), ingested_at=INGESTED, source_file="t"))
    assert lean.select(F.max(F.octet_length("record_hash"))).first()[0] == 17
    stored = FE.customer_lines(lean)
    got = {r[0] for r in stored.select(F.struct("is_return", "is_cancellation")).distinct().collect()}
    assert got == {(False, False)} and stored.where("hour <> hour(invoice_datetime) OR is_weekend <> (dayofweek(invoice_datetime) IN (1, 7))").count() == 0
    files = spark.read.parquet(*{r[0].rsplit("/", 1)[0] for r in stored.select(F.input_file_name()).distinct().collect()})
    assert not {"hour", "is_weekend", "is_return", "is_cancellation", "record_hash"} & set(files.columns)


def test_raw_lines_carry_the_order_key_once(spark):
    lines = plan_of(raw_invoice_lines(spark, SF_SMALL)).split("\n")
    at = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(l_partkey" in ln)
    assert "Project [" in lines[at + 1] and "o_orderkey" not in lines[at + 1]


def test_distinct_products_do_not_multiply_the_aggregate(spark):
    plan = plan_of(FE.customer_line_features(S.valid_sales(clean_of(spark, [line()]), known_customer=True)))
    keyed = [ln for ln in plan.split("\n") if "HashAggregate(keys=[CustomerID" in ln and "StockCode" in ln.split("functions=")[0]]
    assert keyed and all("avg(" not in ln and "stddev" not in ln for ln in keyed)


def lines_by_month(n):
    return [line(inv=f"{i}", code=f"S{i % 5}", date=f"{1 + i % 3}/{1 + i % 27}/2011 8:0{i % 10}", price=0.5 + i % 7, cust=None if i % 8 == 0 else str(i % 11))
            for i in range(n)]


def test_a_months_lines_and_parts_take_one_shuffle(spark):
    clean = clean_of(spark, lines_by_month(60))
    for df, key in ((RF.latest_by_month(clean), "record_hash"), (RF.customer_parts(clean), "CustomerID"), (RF.product_parts(clean), "StockCode")):
        plan = plan_of(df)
        above = plan[:plan.index("Exchange hashpartitioning(year")]  # no shuffle by key or month above the one by both
        assert "Exchange" not in above and key in above
    lean = next(ln for ln in plan_of(RF.customer_parts(clean)).split("\n") if "Exchange hashpartitioning(year" in ln)
    assert "repartition" in lean.lower()


def test_merged_products_take_one_shuffle(spark):
    parts = RF.product_parts(clean_of(spark, lines_by_month(60))).drop(*RF.MONTH)
    path = f"{spark.sparkContext.getCheckpointDir()}/parts-of-{id(parts)}"
    parts.write.parquet(path)
    assert plan_of(RF.merge_products(spark.read.parquet(path))).count("Exchange") == 1


def test_stored_lines_are_those_of_the_plain_cleaning(spark):
    rows = [*lines_by_month(200), *lines_by_month(40)] + [line(inv="9", qty=q, desc=d) for q, d in ((5, "a"), (3, "b"), (3, "a"))]
    rows += [line(inv=None, code=None, desc=None, cust=None), line(inv=None, code=None), line(date="bad")]
    bronze = B.add_lineage(raw_df(spark, rows), ingested_at=INGESTED, source_file="t")
    want = sorted(map(str, S.clean_transactions(bronze).collect()))
    for few in (S.FEW_REPEATED, 0):
        stored = S.stored_clean(bronze, few)
        assert sorted(map(str, stored.collect())) == want
        assert "Exchange hashpartitioning" not in plan_of(stored)  # nothing is de-duplicated when it is read
    assert len(want) < len(rows) - 40


def test_transaction_features_shuffle_lines_once(spark):
    clean = clean_of(spark, lines_by_month(60))
    stored = materialize(clean, "test_lines")
    plan = plan_of(FE.transaction_features(stored))
    wide = [ln for ln in plan.split("\n") if "Exchange hashpartitioning(_tr_key" in ln]
    assert len(wide) == 1 and "SortMergeJoin" not in plan


def test_the_lines_of_an_invoice_come_side_by_side(spark):
    plan = plan_of(raw_invoice_lines(spark, SF_SMALL))
    assert 0 < plan.index("Exchange hashpartitioning(l_orderkey") < plan.index("Exchange hashpartitioning(l_partkey")


def stored_files(spark, df):
    return spark.read.parquet(*{f.rsplit("/", 1)[0] for f in df.inputFiles() if "repeated" not in f})


def test_hashes_that_the_columns_give_again_are_not_stored(spark):
    rows = [*lines_by_month(200), *lines_by_month(40), line(inv=None, code=" a1 "), line(code=None), line(inv=None, code=None)]
    bronze = B.add_lineage(raw_df(spark, rows), ingested_at=INGESTED, source_file="t")
    other = bronze.withColumn("record_hash", F.concat(F.lit("k"), F.col("record_hash")))
    for lines, least in ((bronze, 0), (other, 1)):
        want = sorted(map(str, S.clean_transactions(lines).collect()))
        for few in (S.FEW_REPEATED, 0):
            stored = S.stored_clean(lines, few, raw_code=True)
            assert sorted(map(str, stored.drop(S.RAW_CODE).collect())) == want
            kept = stored_files(spark, stored)
            assert kept.where(F.octet_length("record_hash") > 0).count() == least * kept.count()


def test_transaction_features_shuffle_no_hash_of_their_own(spark):
    rows = [*lines_by_month(150), *lines_by_month(30), line(inv=None, code=" a1 "), line(code=None, cust=None)]
    bronze = B.add_lineage(raw_df(spark, rows), ingested_at=INGESTED, source_file="t")
    other = bronze.withColumn("record_hash", F.when(F.col("CustomerID") == "3", F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("record_hash"))))
    shown = lambda df: sorted(map(str, df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]).collect()))
    for lines in (bronze, other):
        lean = FE.transaction_features(S.stored_clean(lines, raw_code=True))
        assert lean.columns == FE.TRANSACTION_FEATURE_COLUMNS
        assert shown(lean) == shown(FE.transaction_features(materialize(S.clean_transactions(lines), "whole")))
    wide = next(ln for ln in plan_of(lean).split("Exchange hashpartitioning(_tr_key")[1].split("\n") if "Project" in ln)
    assert "sha2" in wide and "StockCode" not in wide.split(" AS record_hash")[-1]
