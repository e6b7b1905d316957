"""E15, continued: items that are bought together.

Support is counted in invoices. The frequent-item cut comes first: an item below the
minimum cannot be in a frequent pair, so its rows never meet others. Pairs are made by
a join on (invoice, block, block): an invoice with many frequent items has them in
several blocks, and each pair of blocks is a key of its own, so the pairs of one
invoice are spread over tasks. Pairs are counted before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.features import basket_items
from tillroll.session import materialize

#: frequent items of an invoice in one block: pairs of a key at most this squared
BLOCK_ITEMS = 256


def frequent_items(baskets: DataFrame, min_invoices: int) -> DataFrame:
    """Items on at least ``min_invoices`` invoices: StockCode, ``item_invoices``."""
    return baskets.groupBy("StockCode").agg(F.count(F.lit(1)).alias("item_invoices")).where(F.col("item_invoices") >= min_invoices)


def paired(baskets: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """All pairs item_a < item_b of each invoice (one row per invoice and pair)."""
    sizes = baskets.groupBy("InvoiceNo").agg(F.ceil(F.count(F.lit(1)) / block_items).cast("int").alias("blocks"))
    items = baskets.join(sizes, "InvoiceNo").select(
        "InvoiceNo", "StockCode", "blocks", F.pmod(F.xxhash64("StockCode"), F.col("blocks")).cast("int").alias("block"))
    # an item meets every block: as the first of a pair on the left, as the second on the right
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = items.select("InvoiceNo", F.col("StockCode").alias("item_a"), F.col("block").alias("block_a"), every.alias("block_b"))
    right = items.select("InvoiceNo", F.col("StockCode").alias("item_b"), F.col("block").alias("block_b"), every.alias("block_a"))
    return left.join(right, ["InvoiceNo", "block_a", "block_b"]).where("item_a < item_b").select("InvoiceNo", "item_a", "item_b")


def item_pairs(clean: DataFrame, min_invoices: int = 2, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Pairs on at least ``min_invoices`` invoices of valid lines: ``invoices``, the
    share of all invoices (``support``), ``confidence`` of b given a and of a given
    b, and ``lift``. Lines without an invoice number or item are in no basket."""
    baskets = materialize(
        basket_items(clean).where("InvoiceNo IS NOT NULL AND StockCode IS NOT NULL").select("InvoiceNo", "StockCode"), "baskets")
    total = baskets.agg(F.count_distinct("InvoiceNo").alias("all_invoices"))
    frequent = materialize(frequent_items(baskets, min_invoices), "frequent_items")
    kept = materialize(baskets.join(frequent.select("StockCode"), "StockCode", "left_semi"), "frequent_baskets")
    pairs = paired(kept, block_items).groupBy("item_a", "item_b").agg(F.count(F.lit(1)).alias("invoices"))
    pairs = pairs.where(F.col("invoices") >= min_invoices)
    for side in ("a", "b"):
        pairs = pairs.join(frequent.select(F.col("StockCode").alias(f"item_{side}"), F.col("item_invoices").alias(f"n_{side}")), f"item_{side}")
    n, n_a, n_b, both = (F.col(c).cast("double") for c in ("all_invoices", "n_a", "n_b", "invoices"))
    return pairs.crossJoin(F.broadcast(total)).select(
        "item_a", "item_b", "invoices", (both / n).alias("support"), (both / n_a).alias("confidence_a_to_b"),
        (both / n_b).alias("confidence_b_to_a"), (both * n / (n_a * n_b)).alias("lift"))
