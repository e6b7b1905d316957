"""Session settings the operators rely on.

The library never builds a cluster session itself; callers pass one in. Two
settings matter for results, not speed:

* ``spark.sql.session.timeZone`` is pinned to UTC so that parsing invoice text
  and truncating to dates give the same instants on every cluster.
* a reliable checkpoint directory (``spark.checkpoint.dir``) under which
  ``materialize`` stores intermediates that several branches read or that
  must not be recomputed (per-customer-country aggregate, product aggregate,
  range-ranked tables, K-Means input). It is read from the session; only a
  local-mode session without one gets a scratch directory of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: of stored intermediates: record hashes (hex text) halve, which snappy leaves whole
STORED_CODEC = "zstd"


def pin_session(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it from conf if needed.

    Order: directory already set on the context → ``spark.checkpoint.dir`` from
    the session conf → (local master only) a fresh scratch directory. On a
    cluster without ``spark.checkpoint.dir`` this raises instead of silently
    using a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master == "local" or sc.master.startswith("local["):
        local_dir = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        sc.setCheckpointDir(local_dir)
        return sc.getCheckpointDir() or local_dir
    raise RuntimeError(
        "set spark.checkpoint.dir to a shared folder (HDFS/S3/DBFS) for this cluster"
    )


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as parquet under the reliable checkpoint directory and
    return the stored table.

    Used where one intermediate is read by several branches of a plan or must
    not be recomputed (nondeterministic positions, float sums): every reader
    sees the same rows, the lineage is cut, and a lost executor costs a re-read,
    not a recomputation. One write job (``DataFrame.checkpoint`` would run the
    plan twice: once to count, once to save)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tillroll-{label}-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", STORED_CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    driver_memory: str = "8g",
    app_name: str = "tillroll",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin_session(spark)
