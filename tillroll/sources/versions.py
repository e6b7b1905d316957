"""Tables that are replaced as a whole or by partition, all at once.

A table's folder holds one folder per load (``load=<id>``) and ``_published``, small
files that each name the folders that make up one version. A write fills a new
folder first and publishes it by renaming one finished file into ``_published``;
readers take the newest file, once, when they build their plan. So

* a write that fails leaves the old version as it was;
* a job may read a table and replace it, as nothing it reads is touched;
* a version may take some partitions from its own load and the others from older
  ones, which stay where they are.

Of two writers at the same time the later publication wins. Folders that no kept
version names are removed by ``prune`` only.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillroll.session import STORED_CODEC

PUBLISHED = "_published"
WHOLE = ""


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its Path class: any store Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def _publications(spark: SparkSession, path: str) -> list[str]:
    fs, Path = _fs(spark, path)
    folder = Path(f"{path}/{PUBLISHED}")
    if not fs.exists(folder):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.endswith(".json"))


def current(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The newest version: partition ("" is the whole table) to load folder; None
    where nothing was published."""
    names = _publications(spark, path)
    return _parts(spark, path, names[-1]) if names else None


def _parts(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    fs, Path = _fs(spark, path)
    stream = fs.open(Path(f"{path}/{PUBLISHED}/{name}"))
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, parts: dict[str, str]) -> None:
    """Make ``parts`` the newest version: a finished file under a hidden name, then
    one rename."""
    fs, Path = _fs(spark, path)
    names = _publications(spark, path)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    name = f"{number:012d}-{uuid.uuid4().hex}.json"
    hidden = Path(f"{path}/{PUBLISHED}/.{name}.tmp")
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps(parts).encode()))
    out.close()
    if not fs.rename(hidden, Path(f"{path}/{PUBLISHED}/{name}")):
        raise OSError(f"could not publish {path}")


def store(df: DataFrame, path: str, cols: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Fill a new load folder, which no version names yet; returns its name."""
    load = f"load={uuid.uuid4().hex}"
    writer = df.write.format(fmt).mode("error")
    if fmt == "parquet":
        writer = writer.option("compression", STORED_CODEC)
    (writer.partitionBy(*cols) if cols else writer).save(f"{path}/{load}")
    return load


def replace_table(df: DataFrame, path: str, cols: Sequence[str] = (), fmt: str = "parquet") -> str:
    """The table becomes ``df`` (rows and schema); returns the new load's folder."""
    load = store(df, path, cols, fmt)
    publish(df.sparkSession, path, {WHOLE: load})
    return f"{path}/{load}"


def partition_name(cols: Sequence[str], values: Sequence) -> str:
    return "/".join(f"{c}={v}" for c, v in zip(cols, values))


def replace_partitions(df: DataFrame, path: str, cols: Sequence[str], touched: Sequence[Sequence], fmt: str = "parquet") -> None:
    """The ``touched`` partitions (values of ``cols``) become those of ``df``, or go
    where ``df`` has no rows of them; the others stay in their older loads."""
    check_partitioned(df.sparkSession, path)
    load = store(df, path, cols, fmt)
    publish_partitions(df.sparkSession, path, cols, {tuple(values): load for values in touched})


def check_partitioned(spark: SparkSession, path: str) -> None:
    if WHOLE in (current(spark, path) or {}):
        raise ValueError(f"{path} was written as a whole: replace it as a whole")


def publish_partitions(spark: SparkSession, path: str, cols: Sequence[str], loads: dict[tuple, str]) -> None:
    """The partitions named by their values become those of the stored loads given, or
    go where a load has none; the others stay in their older loads."""
    check_partitioned(spark, path)
    fs, Path = _fs(spark, path)
    named = {partition_name(cols, values): load for values, load in loads.items()}
    new = {n: load for n, load in named.items() if fs.exists(Path(f"{path}/{load}/{n}"))}
    publish(spark, path, {n: at for n, at in (current(spark, path) or {}).items() if n not in named} | new)


def read_current(spark: SparkSession, path: str, fmt: str = "parquet", partitions: Sequence[str] | None = None,
                 schema: StructType | None = None) -> DataFrame | None:
    """The newest version, or only the named ``partitions`` of it; None where
    there is nothing to read. With a ``schema``, columns that an older load has not are null."""
    parts = current(spark, path)
    if parts is None:
        return None
    if WHOLE in parts:
        return spark.read.format(fmt).load(f"{path}/{parts[WHOLE]}")
    folders = [f"{path}/{at}/{name}" for name, at in sorted(parts.items()) if partitions is None or name in partitions]
    reader = spark.read.format(fmt).option("basePath", path)
    return (reader.schema(schema) if schema else reader).load(folders).drop("load") if folders else None


def prune(spark: SparkSession, path: str, keep: int = 2, spare_hours: float = 24) -> list[str]:
    """Remove load folders that none of the last ``keep`` versions names and that
    are older than ``spare_hours`` (a younger one may be a write in progress)."""
    fs, Path = _fs(spark, path)
    names = _publications(spark, path)
    kept = {load for name in names[-keep:] for load in _parts(spark, path, name).values()}
    removed = []
    for status in fs.listStatus(Path(path)):
        load = status.getPath().getName()
        old = status.getModificationTime() < (time.time() - spare_hours * 3600) * 1000
        if load.startswith("load=") and load not in kept and old:
            fs.delete(status.getPath(), True)
            removed.append(load)
    for name in names[:-keep]:
        fs.delete(Path(f"{path}/{PUBLISHED}/{name}"), False)
    return removed
