"""Gold marts: fixtures for the reference's traps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from helpers import SF_SMALL, clean_of, line
from tillroll.operators import gold as G
from tillroll.operators import serving as SV
from tillroll.plans.registry import AS_OF, clean_df, round_doubles
from tillroll.session import materialize


def _rows(df, key):
    return sorted(round_doubles(df, 6).collect(), key=key)


def test_two_countries_give_two_rows_with_same_rfm(spark):
    rows = [line(inv="1", country="UK", price=10.0), line(inv="2", country="France", price=5.0),
            line(inv="3", cust="2", price=1.0, date="12/5/2010 8:00")]
    c360 = G.customer_360(clean_of(spark, rows), as_of="2010-12-31")
    got = c360.where("CustomerID = 17850").collect()
    assert len(got) == 2
    assert {r.Country for r in got} == {"UK", "France"}
    assert len({(r.monetary, r.frequency, r.rfm_score, r.recency_days) for r in got}) == 1
    assert got[0].monetary == 15.0 and got[0].frequency == 2
    ov = SV.customer_overview(c360).collect()[0]
    assert (ov.total_customers, ov.distinct_customers) == (3, 2)


def test_unique_counts_are_row_counts(spark):
    # reference semantics: unique_* columns count rows, not distinct values
    rows = [line(inv="1"), line(inv="2")]
    c360 = G.customer_360(clean_of(spark, rows), as_of="2010-12-31").collect()[0]
    assert (c360.unique_invoices, c360.unique_products, c360.unique_categories) == (2, 2, 2)
    pm = G.product_metrics(clean_of(spark, rows)).collect()[0]
    assert (pm.unique_customers, pm.unique_buyers) == (2, 2)


def test_moving_average_uses_rows_not_days(spark):
    rows = [line(inv="1", date="1/1/2011 8:00", price=10.0),
            line(inv="2", date="2/1/2011 8:00", price=20.0),
            line(inv="3", date="3/1/2011 8:00", price=60.0)]
    daily = G.daily_aggregates(clean_of(spark, rows)).orderBy("date").collect()
    assert [r.revenue_ma_7d for r in daily] == [10.0, 15.0, 30.0]
    assert daily[0].day_of_week == dt.datetime(2010, 12, 27)  # week start (Monday)


def test_revenue_share(spark):
    rows = [line(inv="1", country="A", price=30.0), line(inv="2", country="B", price=10.0)]
    ca = {r.Country: r for r in G.country_analytics(clean_of(spark, rows)).collect()}
    assert (ca["A"].revenue_share, ca["B"].revenue_share) == (75.0, 25.0)
    assert ca["A"].revenue_per_customer == 30.0


def test_rfm_segments_follow_rule_order(spark):
    df = spark.createDataFrame([(5, 5), (3, 3), (4, 1), (2, 4), (1, 1), (3, 2)], "r int, f int")
    got = [r.s for r in df.select(G.rfm_segment(F.col("r"), F.col("f")).alias("s")).collect()]
    assert got == ["Champions", "Loyal Customers", "Promising", "At Risk", "Hibernating",
                   "Potential Loyalists"]


def test_naive_shapes_give_the_same(spark):
    """The benchmark's yardsticks compute what the operators do."""
    import naive as N

    clean = materialize(clean_df(spark, SF_SMALL), "naive_clean")

    def rows(df):
        shown = df.select(*[F.round(F.col(c) + 3.7e-9, 4).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
        return sorted(map(str, map(tuple, shown.collect())))

    assert rows(N.customer_360_naive(clean, as_of=AS_OF)) == rows(G.customer_360(clean, as_of=AS_OF))
    assert rows(N.product_metrics_naive(clean).drop("performance_category")) == rows(G.product_metrics(clean).drop("performance_category"))
