"""Token ids as Parquet list columns that can be read in part.

``write_token_files`` puts documents in ``doc_id`` order (a range exchange: no
task holds more than its range, and equal ids are spread by text), encodes each
range where it lies and writes it with

* ``ids`` as a list column in dictionary pages (a vocabulary fits one
  dictionary page of a row group),
* ``doc_id``, ``start_in_part`` and ``n_tokens`` in delta encoding,
* row groups and pages of stated sizes, and the page index that Parquet writers
  add, so that a range of documents or the metadata alone are read without the
  other ids.

Edge cases: null texts are empty and hold the end id alone; null ids come first;
repeated rows are all written; other columns are ignored; no rows: no ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.bpe import encoder
from tillroll.llm.common import texts

SCHEMA = "doc_id long, part int, start_in_part long, n_tokens long, ids array<int>"


@dataclass(frozen=True)
class Layout:
    """How token files are cut. Row groups bound what a reader holds, pages
    what a selective read decodes."""

    row_group_bytes: int = 32 << 20
    page_bytes: int = 256 << 10
    page_rows: int = 512
    dictionary_bytes: int = 1 << 20
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.dictionary.page.size": str(self.dictionary_bytes),
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.enable.dictionary": "true",
            "parquet.enable.dictionary#doc_id": "false",
            "parquet.enable.dictionary#start_in_part": "false",
            "parquet.enable.dictionary#n_tokens": "false",
            "compression": self.compression,
        }


def list_array(parts: list[np.ndarray]) -> pa.Array:
    """An Arrow list<int32> of id arrays."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))


def _encode(end_id: int, vocabulary: str | None):
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, start = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids = [np.concatenate([x, end]) for x in enc.encode(rows["text"].to_pylist())]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], pa.array([part] * len(ids), pa.int32()), pa.array(start + ends - sizes),
                     pa.array(sizes), list_array(ids)],
                    ["doc_id", "part", "start_in_part", "n_tokens", "ids"])
                start += int(ends[-1])

    return run


def write_token_files(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None,
                      layout: Layout = Layout()) -> None:
    """Write the ids of every document, in ascending ``doc_id`` order over the
    files' parts, with ``end_id`` at each document's end."""
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(_encode(end_id, vocabulary), SCHEMA).write.options(**layout.options()).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with ``start``, the ids of all documents before each.
    Offsets of parts come from the metadata columns alone: one row per part."""
    files = spark.read.schema(SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        files.groupBy("part").agg(F.sum("n_tokens").alias("_size"))
        .select("part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    return (
        files.join(F.broadcast(parts), "part")
        .withColumn("start", F.col("start_in_part") + F.col("_before"))
        .drop("_before")
    )


def token_digests(files: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and the CRC-32 of the ids as
    little-endian 32-bit integers, of rows that ``read_token_files`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            cut, flat = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy().astype("<u4")).cast("B")
            crc = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["start"], batch["n_tokens"], pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")
