"""Connected components of a link table, by contraction.

Each round hooks every node to its smallest neighbour, follows the pointers to
their roots by doubling and keeps the links between different roots. Nodes at
least halve each round, so rounds and doublings are logarithmic; everything is
joins and minima of stored tables, nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize


def _to_roots(pointers: DataFrame) -> DataFrame:
    """(node, root) of pointers (node, root) that lead to smaller nodes."""
    while True:
        up = pointers.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        stored = materialize(
            pointers.join(up, "root", "left").select(
                "node", F.coalesce("_up", "root").alias("root"),
                (F.coalesce("_up", "root") != F.col("root")).alias("moved")),
            "pointers")
        pointers = stored.select("node", "root")
        if not stored.filter("moved").limit(1).count():
            return pointers


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of all nodes of
    links (a, b). Loops, null ends and repeated links do no harm."""
    links = materialize(links.select("a", "b").filter("a <> b"), "links")
    labels: DataFrame | None = None
    while links.limit(1).count():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
        roots = _to_roots(pointers.withColumn("root", F.least("node", "root")))
        of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        links = materialize(
            links.join(of_a, "a").join(of_b, "b").filter("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            "links")
        if labels is None:
            labels = roots.withColumnRenamed("root", "component")
        else:
            up = roots.select(F.col("node").alias("component"), "root")
            labels = materialize(
                labels.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component")),
                "labels")
    if labels is None:
        labels = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
