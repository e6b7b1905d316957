"""A10, load by load: marts from mergeable parts instead of a full rebuild.

Clean lines (``stored_lines`` reads them) and three tables of parts are kept by month:

* per (CustomerID, Country), per (StockCode, Description) and per (date, Country)
  the counts, sums, extremes and second moments of ``operators.gold``.

A load touches the months of its lines (a line's month follows from its record
hash, which holds the invoice date, so a line that comes again meets its older copy
in the same month). Only the touched months' lines are read, de-duplicated with the
load and aggregated into parts anew; every other month's lines and parts
stay as they are stored. The marts are then merged from the parts of all months; a
part is a customer's or product's month, which may hold few lines. A load may be repeated
or bring newer copies of old lines: the result is that of one full rebuild.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import line_amount, safe_div
from tillroll.operators import bronze as B
from tillroll.operators import gold as G
from tillroll.operators import silver as S
from tillroll.session import materialize, pin_session
from tillroll.sources import versions
from tillroll.sources.io import table_path, write_table

MONTH = ["year", "month"]

#: a month's rows are dealt over so many groups by their key
GROUPS = 16
GROUP = "_tr_group"


def grouped(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.withColumn(GROUP, F.pmod(F.xxhash64(*keys), F.lit(GROUPS)).cast("int"))


def by_month(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a month and a group of keys in one partition: one shuffle serves what is
    done per key and the files per month. AQE joins small partitions."""
    return grouped(rows, *keys).repartition(*MONTH, GROUP)


#: of a line, what the lines of an invoice mostly share; their other columns come behind:
#: equal bytes lie together in a shuffle
SHARED = ["is_return", "is_cancellation", "is_weekend", "year", "month", "hour", "invoice_datetime", "Country", "CustomerID"]


def _marked(lines: DataFrame, own: Sequence[str], *counted: str) -> DataFrame:
    """``lines`` with a mark in place of the texts that are only counted, ``own`` columns last."""
    return lines.select(*[F.when(F.col(c).isNotNull(), F.lit("")).alias(c) for c in counted], *SHARED, *own)


def customer_parts(lines: DataFrame) -> DataFrame:
    lean = by_month(_marked(lines, ["Quantity", "total_price"], "InvoiceNo", "StockCode", "Description"), "CustomerID", "Country")
    return G.customer_country_stats(lean, by=[*MONTH, GROUP]).drop(GROUP)


def product_parts(lines: DataFrame) -> DataFrame:
    # the amount is computed again behind the shuffle
    lean = by_month(_marked(lines, ["StockCode", "Description", "Quantity", "UnitPrice"], "InvoiceNo"), "StockCode", "Description")
    stats = G.product_line_stats(lean.withColumn("total_price", line_amount()), by=[*MONTH, GROUP]).drop(GROUP)
    return stats.withColumns({c: F.when(~F.col(c).eqNullSafe(F.expr(same)), F.col(c)) for c, same in SPARED.items()})


#: figures that a part leaves out where they equal these, as of a product's only line
#: in a month
SPARED = {"min_price": "avg_price", "max_price": "avg_price", "total_revenue": "CAST(total_quantity_sold AS DOUBLE) * avg_price"}


def _whole(c: str):
    """A figure of a part, or what it left it out for."""
    n = F.col("_n_price" if c == "total_revenue" else "_n_unit")
    return F.when(n > 0, F.coalesce(F.col(c), F.expr(SPARED[c])))


def daily_parts(lines: DataFrame) -> DataFrame:
    daily = G.daily_sales(lines).select("*", F.year("date").alias("year"), F.month("date").alias("month"))
    return daily.hint("rebalance", *MONTH)


# the parts of a table of clean lines, by month, a month's rows in few partitions
PARTS = {"customer_parts": customer_parts, "product_parts": product_parts, "daily_parts": daily_parts}


def merge_customers(parts: DataFrame) -> DataFrame:
    """``gold.customer_country_stats`` from its parts."""
    summed = ["total_transactions", "total_spent", "unique_products_purchased", "_rows", "_n_price", "_qty_sum", "_qty_n",
              "_n_stock", "_n_desc", "_weekend", "_hour_sum", "_hour_n"]
    return parts.groupBy("CustomerID", "Country").agg(
        F.min("first_purchase_date").alias("first_purchase_date"), F.max("last_purchase_date").alias("last_purchase_date"),
        F.max("_max_price").alias("_max_price"), F.min("_min_price").alias("_min_price"),
        *[F.sum(c).alias(c) for c in summed],
    ).withColumn("avg_transaction_value", safe_div("total_spent", "_n_price"))


def merge_products(parts: DataFrame) -> DataFrame:
    """``gold.product_line_stats`` from its parts; second moments by the parallel
    formula M2 = sum(M2_g + n_g * (mean_g - mean)^2)."""
    keys = ["StockCode", "Description"]
    summed = ["times_purchased", "total_quantity_sold", "total_revenue", "unique_customers", "_n_price", "_n_unit"]
    # a product has a row a month: its mean by a window, its sums in the same partition
    own = Window.partitionBy(*keys)
    mean = safe_div(F.sum(F.col("avg_price") * F.col("_n_unit")).over(own), F.sum("_n_unit").over(own))
    # what most parts share comes first: equal bytes lie together in the shuffle
    lean = parts.select("times_purchased", "unique_customers", "_n_price", "_n_unit", "_m2_unit", *SPARED, *keys, "total_quantity_sold", "avg_price")
    return lean.withColumn("_mean", mean).groupBy(*keys).agg(
        *[F.sum(_whole(c) if c in SPARED else c).alias(c) for c in summed],
        F.min(_whole("min_price")).alias("min_price"), F.max(_whole("max_price")).alias("max_price"),
        F.max("_mean").alias("avg_price"),
        F.sum(F.col("_m2_unit") + F.col("_n_unit") * F.pow(F.col("avg_price") - F.col("_mean"), 2)).alias("_m2_unit"))


def merge_countries(daily: DataFrame) -> DataFrame:
    """``gold.country_sales`` from the parts per (date, Country)."""
    return daily.groupBy("Country").agg(
        F.sum("unique_customers").alias("unique_customers"), F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_revenue").alias("total_revenue"), safe_div(F.sum("total_revenue"), F.sum("_n_price")).alias("avg_order_value"),
        F.sum("total_items_sold").alias("total_items_sold"), F.sum("unique_products_sold").alias("unique_products"))


def latest_by_month(lines: DataFrame) -> DataFrame:
    """C12 and C6-C11 over parsed lines, with a month's lines in few partitions. A
    record hash holds the invoice date, so its copies are in one month."""
    ts, keep = F.col("invoice_datetime"), [c for c in lines.columns if c == S.RAW_CODE]
    dealt = grouped(lines.select(*S.BRONZE_COLUMNS, ts, F.year(ts).alias("year"), F.month(ts).alias("month"), *keep), "record_hash")
    keys = [*MONTH, GROUP, "record_hash"]
    if keep:  # the shuffle carries no hash that the line's own columns give again
        lean = dealt.withColumn("record_hash", S.spared_hash()).repartition(*MONTH, GROUP)
        return S.enrich(S.dedupe_latest(lean.withColumn("record_hash", S.restored_hash()), keys=keys), keep)
    lean = dealt.withColumn("record_hash", S.packed_hash()).repartition(*MONTH, GROUP)
    return S.enrich(S.dedupe_latest(lean, keys=keys).withColumn("record_hash", S.unpacked_hash()))


def spared(lines: DataFrame) -> DataFrame:
    """Lines as they are stored: where a line's columns give its hash again, the raw
    stock code is kept in place of the hash."""
    own = F.coalesce(F.col(S.RAW_CODE).isNotNull() & (F.col("record_hash") == S.own_hash()), F.lit(False))
    return lines.withColumns({"record_hash": F.when(~own, F.col("record_hash")), S.RAW_CODE: F.when(own, F.col(S.RAW_CODE))})


def restored(stored: DataFrame) -> DataFrame:
    return stored.withColumn("record_hash", F.when(F.col(S.RAW_CODE).isNotNull(), S.own_hash()).otherwise(F.col("record_hash")))


def stored_lines(spark: SparkSession, base: str, months: Sequence[tuple[int, int]]) -> DataFrame:
    """The stored clean lines of some months (``silver.SILVER_COLUMNS``), with the raw stock
    code where their hash was made of it."""
    held = table_path(base, "silver", "lines_by_month")
    names = [versions.partition_name(MONTH, m) for m in months]
    schema = versions.read_current(spark, held, partitions=names).drop(*MONTH).schema
    if S.RAW_CODE not in schema.names:  # of a load that was stored with all hashes
        schema = schema.add(S.RAW_CODE, "string")
    stored = versions.read_current(spark, held, partitions=names, schema=schema)
    return restored(stored).select(*S.SILVER_COLUMNS, S.RAW_CODE)


def latest_of_load(lines: DataFrame, few: int = S.FEW_REPEATED) -> DataFrame:
    """``latest_by_month`` of a load, shuffling only the lines that may be copies."""
    single, repeated = S.split_repeated(lines, few)
    latest = latest_by_month(repeated)
    return latest if single is None else S.enrich(single, [c for c in lines.columns if c == S.RAW_CODE]).unionByName(latest)


def add_load(bronze: DataFrame, base: str) -> list[tuple[int, int]]:
    """Take one load of lines with lineage (``bronze.add_lineage``) into the stored
    months; returns the months it touched. The load is stored by month; a month that
    holds no lines yet takes its part as it is, any other is de-duplicated with it.
    ``bronze`` is read three times: store it where it is not a file."""
    spark = pin_session(bronze.sparkSession)
    held = table_path(base, "silver", "lines_by_month")
    versions.check_partitioned(spark, held)
    clean = latest_of_load(S.parse_and_validate(bronze, [S.raw_code_column()]))
    load = versions.store(spared(clean), held, MONTH)
    new = spark.read.schema(clean.schema).option("basePath", f"{held}/{load}").parquet(f"{held}/{load}")
    touched = sorted(map(tuple, new.select(*MONTH).distinct().collect()))  # months of a load
    if not touched:
        return []
    stored = versions.current(spark, held) or {}
    again = [m for m in touched if versions.partition_name(MONTH, m) in stored]
    loads = dict.fromkeys(touched, load)
    if again:
        old = stored_lines(spark, base, again)
        same = F.struct(*MONTH).isin([F.struct(*[F.lit(v).alias(c) for c, v in zip(MONTH, m)]) for m in again])
        both = old.unionByName(restored(new.where(same)))
        loads |= dict.fromkeys(again, versions.store(spared(latest_by_month(both)), held, MONTH))
    versions.publish_partitions(spark, held, MONTH, loads)
    lines = stored_lines(spark, base, touched)
    for name, parts in PARTS.items():
        versions.replace_partitions(parts(lines), table_path(base, "gold", name), MONTH, touched)
    return touched


def parts(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One of the stored tables of ``PARTS``, all months."""
    return versions.read_current(spark, table_path(base, "gold", name)).drop(*MONTH)


def marts(spark: SparkSession, base: str, as_of=None) -> dict[str, DataFrame]:
    """The four marts from the stored parts, without a line being read."""
    pin_session(spark)
    customers = materialize(merge_customers(parts(spark, base, "customer_parts")), "merged_customers")
    products = materialize(merge_products(parts(spark, base, "product_parts")), "merged_products")
    daily = parts(spark, base, "daily_parts")
    return {
        "customer_360": G.customer_360(None, as_of=as_of, cc=customers),
        "product_metrics": G.product_metrics(None, pls=products),
        "daily_aggregates": G.daily_mart(daily),
        "country_analytics": G.country_mart(merge_countries(daily)),
    }


def refresh(spark: SparkSession, base: str, raw: DataFrame, as_of=None, ingested_at=None, source_name: str | None = None) -> list[tuple[int, int]]:
    """Take a load of raw lines and replace the stored marts."""
    touched = add_load(B.add_lineage(raw, ingested_at=ingested_at, source_file=source_name), base)
    if touched:
        for name, mart in marts(spark, base, as_of).items():
            write_table(mart, base, "gold", name)
    return touched
