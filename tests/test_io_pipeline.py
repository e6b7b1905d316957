"""Sources/sinks round trips and the batch chain end to end."""

from __future__ import annotations

import os
import tempfile

from helpers import SF_SMALL, line, raw_df
from tillroll.operators import segmentation as SG
from tillroll.operators.bronze import ingest_transactions
from tillroll.plans.pipeline import run_pipeline
from tillroll.sources import io
from tillroll.sources.schema import RAW_SCHEMA
from tillroll.sources.tables import raw_invoice_lines


def test_csv_round_trip(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tillroll-csv-"), "people")
    df = io.rows_source(spark, [(1, "Alice", 29, "Engineer"), (2, "Bob", 35, "Data Scientist")],
                        ["id", "name", "age", "role"])
    io.write_csv(df, path, single_file=True)
    back = io.read_csv(spark, path)
    assert back.columns == ["id", "name", "age", "role"]
    assert sorted(tuple(r) for r in back.collect()) == [("1", "Alice", "29", "Engineer"),
                                                       ("2", "Bob", "35", "Data Scientist")]


def test_read_raw_uses_declared_schema(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="tillroll-raw-"), "lines")
    raw_df(spark, [line(), line(inv="2", cust=None)]).write.option("header", "true").csv(path)
    back = io.read_raw(spark, path, fmt="csv")
    assert back.columns == [*RAW_SCHEMA.names, "_corrupt_record"]
    assert all(r._corrupt_record is None for r in back.collect())
    assert sorted((r.InvoiceNo, r.CustomerID) for r in back.collect()) == [("1001", "17850"), ("2", None)]


def test_quoted_cells_are_kept_and_bad_lines_counted(spark):
    base = tempfile.mkdtemp(prefix="tillroll-quotes-")
    path = os.path.join(base, "lines.csv")
    with open(path, "w") as f:
        f.write(",".join(RAW_SCHEMA.names) + "\n")
        f.write('1,A,"12"" PLATE, RED",6,12/1/2010 8:26,2.5,17850,UK\n')
        f.write("2,B,PLAIN,six,12/1/2010 8:26,2.5,17850,UK\n")
    rows = {r.InvoiceNo: r for r in io.read_raw(spark, path).collect()}
    assert (rows["1"].Description, rows["1"].Quantity, rows["1"].Country) == ('12" PLATE, RED', 6, "UK")
    stored, quality = ingest_transactions(spark, path, base)
    row = quality.first()
    assert (row.total_rows, row.corrupt_rows) == (2, 1)
    assert {r.source_file.rsplit("/", 1)[-1] for r in spark.read.parquet(stored).collect()} == {"lines.csv"}
    out = os.path.join(base, "csv")
    odd = spark.createDataFrame([('a "b", c', "line\nbreak"), ("\\", None)], "x string, y string")
    io.write_csv(odd, out)
    assert sorted(map(tuple, io.read_csv(spark, out, multi_line=True).collect()), key=str) == sorted(map(tuple, odd.collect()), key=str)


def test_partitioned_files_follow_the_data(spark):
    base = tempfile.mkdtemp(prefix="tillroll-files-")
    df = spark.range(0, 4000, 1, 16).selectExpr("id AS v", "CAST(2010 + id % 2 AS INT) AS year", "CAST(1 + id % 12 AS INT) AS month")
    path = io.write_partitioned(df.select("year", "v", "month"), base, "gold", "daily_aggregates")
    files = [f for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) == 12
    assert io.read_table(spark, base, "gold", "daily_aggregates", columns=["year", "v", "month"]).columns == ["year", "v", "month"]


def test_partitioned_table_round_trip(spark):
    base = tempfile.mkdtemp(prefix="tillroll-tbl-")
    df = spark.createDataFrame([(2010, 12, 1.0), (2011, 1, 2.0)], "year int, month int, v double")
    stored = io.write_table(df, base, "gold", "daily_aggregates")
    assert os.path.isdir(os.path.join(stored, "year=2010"))
    back = io.read_table(spark, base, "gold", "daily_aggregates")
    assert sorted((r.year, r.month, r.v) for r in back.collect()) == [(2010, 12, 1.0), (2011, 1, 2.0)]
    pruned = back.where("year = 2011")
    assert "PartitionFilters: [isnotnull(year" in pruned._jdf.queryExecution().executedPlan().toString()


def test_pipeline_end_to_end(spark):
    base = tempfile.mkdtemp(prefix="tillroll-pipe-")
    timings = run_pipeline(spark, base, source=raw_invoice_lines(spark, SF_SMALL),
                           as_of="2001-08-01", ingested_at="2001-08-02 00:00:00", sweep=[2, 3])
    assert list(timings) == ["bronze", "silver", "gold", "features", "ml"]
    read = lambda layer, name: io.read_table(spark, base, layer, name)
    assert read("silver", "transactions_clean").count() == 5751
    assert len(read("gold", "customer_360").columns) == 29
    assert len(read("feature_store", "customer_features").columns) == 62
    assert len(read("feature_store", "transaction_features").columns) == 31
    assert read("gold", "customer_segments").count() > 0
    assert read("models", "k_sweep").count() == 2
    # the saved model, loaded again, gives the stored clusters
    model = SG.load_model(spark, os.path.join(base, "models", "segmentation"))
    scored = SG.assign_clusters(SG.prepare_features(read("feature_store", "customer_features")), model)
    pairs = ["CustomerID", "cluster_id", "avg_transaction_value"]
    assert sorted(scored.select(*pairs).collect()) == sorted(read("gold", "customer_segments").select(*pairs).collect())
    # a later run may skip ingestion and redo one step from stored tables
    again = run_pipeline(spark, base, steps=["gold"], skip_bronze=True, as_of="2001-08-01")
    assert list(again) == ["gold"]


def test_materialize_writes_under_session_checkpoint_dir(spark):
    from tillroll.session import ensure_checkpoint_dir, materialize

    ckpt = ensure_checkpoint_dir(spark)
    assert ckpt == spark.sparkContext.getCheckpointDir()
    df = spark.range(10).withColumnRenamed("id", "x")
    stored = materialize(df, "unit")
    from urllib.parse import urlparse

    root = urlparse(ckpt).path.rstrip("/")
    files = [urlparse(f).path for f in stored.inputFiles()]
    assert files and all(f.startswith(root + "/") for f in files)
    assert sorted(r.x for r in stored.collect()) == list(range(10))
