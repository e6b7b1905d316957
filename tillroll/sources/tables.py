"""Driver tables and the adapter that shapes them into raw invoice lines.

The driver ships TPC-H-like parquet tables; the operators consume invoice
lines (``RAW_SCHEMA``). ``raw_invoice_lines`` is the deterministic shaping rule
of FIXTURES.md §2 (one invoice line per ``lineitem`` row), written as a join
plan Spark can run at any scale:

* every table is read with only the columns the rule needs (pruned scan);
* ``nation`` is a fixed 25-row dimension, the one side broadcast explicitly, and
  joined last: the shuffles carry its key, not its name;
* orders are joined to customer first (orders-sized), lineitem is
  joined to part and then to it with sort-merge joins (``merge`` hints): lineitem
  is shuffled once on the part key and once on the order key, which spreads
  the per-line work over the shuffle partitions even when a scan has a single
  split. The order comes last, so that the lines of an invoice lie side by side:
  what they share costs little in the files and shuffles that follow. Supplier, line number and return flag are only asked yes/no questions,
  so one small number travels in their place. The hints stop the static planner from choosing the fact table as a
  broadcast build side when a projected scan is under-estimated; neither
  orders nor part has a size bound that would justify a broadcast.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import pin_session

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw invoice lines (8 string/int/double columns) from the driver tables."""
    pin_session(spark)
    # what the rule asks of supplier, line number and return flag, as one small number:
    # +1 no price, +2 price -1, +4 a returned line, +8 a seventh line
    seventh = F.col("l_linenumber") == 7
    marks = (
        F.when((F.col("l_suppkey") % 40 == 3) & seventh, 1).when((F.col("l_suppkey") % 40 == 5) & seventh, 2).otherwise(0)
        + F.when(F.col("l_returnflag") == "R", 4).otherwise(0) + F.when(seventh, 8).otherwise(0)
    )
    keyed = F.col("l_orderkey").isNotNull() & F.col("l_partkey").isNotNull()
    li = load(spark, sf_dir, "lineitem").where(keyed).select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", marks.alias("marks"))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")

    order_side = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "c_nationkey")
    joined = li.join(part.hint("merge"), li.l_partkey == part.p_partkey).join(
        order_side.hint("merge"), F.col("l_orderkey") == order_side.o_orderkey
    ).join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.expr(
            "CASE WHEN marks & 4 > 0 AND l_orderkey % 8 = 0 "
            "THEN concat('C', CAST(l_orderkey AS STRING)) ELSE CAST(l_orderkey AS STRING) END"
        ).alias("InvoiceNo"),
        F.expr("concat(' p', CAST(l_partkey AS STRING), ' ')").alias("StockCode"),
        F.expr(
            "CASE WHEN l_partkey % 50 = 0 THEN NULL "
            "WHEN l_partkey % 40 = 1 AND marks & 8 > 0 THEN concat(p_name, ' v2') "
            "ELSE p_name END"
        ).alias("Description"),
        F.expr(
            "CAST(CASE WHEN marks & 4 > 0 AND l_orderkey % 4 = 0 "
            "THEN -l_quantity ELSE l_quantity END AS INT)"
        ).alias("Quantity"),
        F.expr(
            "CASE WHEN l_orderkey % 500 = 1 THEN 'n/a' "
            "ELSE date_format(o_orderdate + make_dt_interval(0, CAST(l_orderkey % 24 AS INT), "
            "CAST((l_orderkey * 7) % 60 AS INT)), 'M/d/yyyy H:mm') END"
        ).alias("InvoiceDate"),
        F.expr(
            "CASE WHEN marks & 1 > 0 THEN NULL "
            "WHEN marks & 2 > 0 THEN -1.0D "
            "ELSE l_extendedprice / l_quantity / "
            "(CASE l_partkey % 3 WHEN 0 THEN 20000 WHEN 1 THEN 8000 ELSE 1000 END) END"
        ).alias("UnitPrice"),
        F.expr(
            "CASE WHEN o_custkey % 25 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END"
        ).alias("CustomerID"),
        F.expr(
            "CASE WHEN o_custkey % 30 = 1 AND l_orderkey % 2 = 0 THEN 'NATION_0' "
            "WHEN l_orderkey % 200 = 7 THEN concat(n_name, ' ') ELSE n_name END"
        ).alias("Country"),
    )
