"""A10: the batch chain bronze -> silver -> gold -> features -> ml over stored tables.

Each step reads the previous layer's stored tables and overwrites its own, so
every layer boundary is also a lineage cut (a failed step is re-run from the
stored input, not from the raw file). Steps are plain function calls; Spark
schedules the work inside each write.
"""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import bronze as B
from tillroll.operators import features as FE
from tillroll.operators import gold as G
from tillroll.operators import segmentation as SG
from tillroll.operators import silver as S
from tillroll.session import pin_session
from tillroll.sources.io import read_raw, read_table, write_table

STEPS = ("bronze", "silver", "gold", "features", "ml")


def run_pipeline(
    spark: SparkSession,
    base: str,
    source: DataFrame | str | None = None,
    source_fmt: str = "csv",
    steps: Iterable[str] = STEPS,
    skip_bronze: bool = False,
    fmt: str = "parquet",
    as_of=None,
    ingested_at=None,
    source_name: str = "dataframe",
    k: int = SG.DEFAULT_K,
    sweep: Iterable[int] | None = range(2, 11),
) -> dict[str, float]:
    """Run the chosen steps in order; returns wall seconds per step.

    ``source`` is a raw-lines DataFrame or a file path (read with the declared
    schema); it is only needed for the bronze step. ``source_name`` is the
    lineage of a DataFrame source; a path's lines keep their file."""
    pin_session(spark)
    wanted = [s for s in STEPS if s in set(steps) and not (skip_bronze and s == "bronze")]
    timings: dict[str, float] = {}

    def read(layer: str, name: str) -> DataFrame:
        return read_table(spark, base, layer, name, fmt=fmt)

    for step in wanted:
        t0 = time.time()
        if step == "bronze":
            if source is None:
                raise ValueError("the bronze step needs a source")
            raw = source if isinstance(source, DataFrame) else read_raw(spark, source, fmt=source_fmt)
            named = source_name if isinstance(source, DataFrame) else None
            write_table(B.add_lineage(raw, ingested_at=ingested_at, source_file=named), base, "bronze",
                        "transactions", fmt=fmt)
        elif step == "silver":
            write_table(S.clean_transactions(read("bronze", "transactions")), base, "silver",
                        "transactions_clean", fmt=fmt)
            clean = read("silver", "transactions_clean")
            write_table(S.customer_profiles(clean, as_of=as_of), base, "silver", "customers", fmt=fmt)
            write_table(S.product_catalog(clean), base, "silver", "products", fmt=fmt)
        elif step == "gold":
            clean = read("silver", "transactions_clean")
            write_table(G.customer_360(clean, as_of=as_of), base, "gold", "customer_360", fmt=fmt)
            write_table(G.product_metrics(clean), base, "gold", "product_metrics", fmt=fmt)
            write_table(G.daily_aggregates(clean), base, "gold", "daily_aggregates", fmt=fmt)
            write_table(G.country_analytics(clean), base, "gold", "country_analytics", fmt=fmt)
        elif step == "features":
            clean = read("silver", "transactions_clean")
            write_table(
                FE.customer_features(clean, as_of=as_of, c360=read("gold", "customer_360")),
                base, "feature_store", "customer_features", fmt=fmt,
            )
            write_table(
                FE.product_features(clean, pm=read("gold", "product_metrics")),
                base, "feature_store", "product_features", fmt=fmt,
            )
            write_table(FE.transaction_features(clean), base, "feature_store",
                        "transaction_features", fmt=fmt)
        elif step == "ml":
            cf = read("feature_store", "customer_features")
            segments, _profiles, costs = SG.run_segmentation(
                cf, k=k, sweep=sweep, model_path=f"{base.rstrip('/')}/models/segmentation"
            )
            write_table(segments, base, "gold", "customer_segments", fmt=fmt)
            if costs is not None:
                write_table(costs, base, "models", "k_sweep", fmt=fmt)
        timings[step] = time.time() - t0
    return timings
