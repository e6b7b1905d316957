"""Plan shapes the scale design depends on (checked on the physical plan), and
a hot-key fixture where one customer holds a third of all lines."""

from __future__ import annotations

from helpers import SF_SMALL, clean_of, line
from tillroll.operators import features as FE
from tillroll.operators import gold as G
from tillroll.plans.registry import AS_OF, clean_df
from tillroll.sources.tables import raw_invoice_lines


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_top1_runs_before_the_shuffle(spark):
    plan = plan_of(clean_df(spark, SF_SMALL))
    lines = plan.split("\n")
    exch = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(record_hash" in ln)
    below = "\n".join(lines[exch:])
    assert "WindowGroupLimit" in below and "Partial" in below


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = plan_of(raw_invoice_lines(spark, SF_SMALL))
    li = next(ln for ln in plan.split("\n") if "FileScan parquet" in ln and "lineitem" in ln)
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_partkey)]" in li
    assert "l_comment" not in li and "l_shipdate" not in li and "l_tax" not in li


def test_fact_table_is_never_a_broadcast_build_side(spark):
    plan = plan_of(raw_invoice_lines(spark, SF_SMALL))
    assert plan.count("SortMergeJoin") == 2
    for ln in plan.split("\n"):
        if "BroadcastExchange" in ln:
            assert "l_orderkey" not in ln


def test_gap_window_runs_on_per_day_rows(spark):
    clean = clean_df(spark, SF_SMALL)
    plan = plan_of(FE.purchase_gap_features(clean))
    lines = plan.split("\n")
    win = next(i for i, ln in enumerate(lines) if "Window [lag(" in ln)
    below = "\n".join(lines[win:])
    # the lag window's input is the (CustomerID, day) aggregate, not the lines
    assert "HashAggregate(keys=[CustomerID" in below
    first_agg = next(ln for ln in lines[win:] if "HashAggregate" in ln)
    assert "count(1)" in first_agg


def test_distributed_rfm_has_no_ntile_window(spark):
    c360 = G.customer_360(clean_df(spark, SF_SMALL), as_of=AS_OF)
    plan = plan_of(c360)
    assert "ntile" not in plan.lower()
    # the only rows in one task are per-partition counts and one row of tile starts
    for part in plan.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_tr_pid" in part or "partial_collect_list" in part or "partial_max" in part


def test_scalars_are_broadcast_not_collected(spark):
    plan = plan_of(G.country_analytics(clean_df(spark, SF_SMALL)))
    assert "BroadcastNestedLoopJoin" in plan or "BroadcastExchange IdentityBroadcastMode" in plan


def test_hot_customer_holding_a_third_of_lines(spark):
    # customer 1 holds 1/3 of the lines, spread over many days and products
    rows = []
    for i in range(600):
        cust = "1" if i % 3 == 0 else str(2 + i % 40)
        day = 1 + (i * 7) % 28
        rows.append(line(inv=str(1000 + i // 2), code=f"P{i % 17}", qty=1 + i % 5,
                         date=f"11/{day}/2010 {i % 24}:{i % 60:02d}", price=1.0 + (i % 9),
                         cust=cust, country="UK" if i % 7 else "FR"))
    rows += [line(inv=f"G{i}", code="P1", cust=None) for i in range(50)]  # guests
    clean = clean_of(spark, rows)
    key = lambda r: (r.CustomerID, r.Country)
    ours = G.customer_360(clean, as_of="2010-12-31")
    lines = [r for r in clean.collect() if r.CustomerID is not None and not r.is_return and not r.is_cancellation]
    hot = [r for r in ours.collect() if r.CustomerID == 1]
    mine = [r for r in lines if r.CustomerID == 1]
    assert {r.frequency for r in hot} == {len(mine)}
    assert {round(r.monetary, 6) for r in hot} == {round(sum(x.total_price for x in mine), 6)}
    cf = FE.customer_features(clean, as_of="2010-12-31", c360=ours)
    assert [key(r) for r in sorted(cf.collect(), key=key)] == [key(r) for r in sorted(ours.collect(), key=key)]
    tf = FE.transaction_features(clean)
    assert tf.count() == clean.count()
    assert tf.where("CustomerID IS NULL AND customer_avg_price IS NOT NULL").count() == 0
    hot = tf.where("CustomerID = 1").select("customer_avg_price").distinct().count()
    assert hot == 1
