from __future__ import annotations

import glob
import json
import os
import time

import pytest
from conftest import sorted_rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerloom.plans import LayerPaths, bronze_to_silver, raw_to_bronze, silver_to_gold
from ledgerloom.schema import BRONZE_SCHEMA, GOLD_SCHEMAS
from ledgerloom.sources import land_run, read_table, retail_view
from ledgerloom.streaming import ingest_new_runs


def bronze_ids(spark, path):
    rows = read_table(spark, path, BRONZE_SCHEMA).collect()
    return sorted(row.transaction_id for row in rows)


def test_each_run_is_ingested_once(spark, transactions, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    land_run(transactions({"transaction_id": 1}), raw, "run_1")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1]
    land_run(transactions({"transaction_id": 2}, {"transaction_id": 2}), raw, "run_2")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1, 2, 2]
    ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1, 2, 2]


def test_files_with_an_old_time_are_not_skipped(spark, transactions, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    land_run(transactions({"transaction_id": 1}), raw, "run_1")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    run = land_run(transactions({"transaction_id": 2}), raw, "run_2")
    last_year = time.time() - 365 * 24 * 3600
    for file in glob.glob(f"{run}/*"):
        os.utime(file, (last_year, last_year))
    ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1, 2]


def test_nothing_is_lost_after_years(spark, transactions, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    years = 2000 * 24 * 3600
    interval = "spark.sql.streaming.fileSink.log.compactInterval"
    spark.conf.set(interval, "2")
    try:
        land_run(transactions({"transaction_id": 1}), raw, "run_1")
        ingest_new_runs(spark, raw, bronze, checkpoint)
        # As if the first batch had been written years ago.
        log = f"{bronze}/_spark_metadata/0"
        version, *entries = open(log).read().splitlines()
        entries = [json.loads(entry) for entry in entries]
        with open(log, "w") as file:
            file.write("\n".join([version, *(json.dumps(e | {"modificationTime": e["modificationTime"] - years * 1000}) for e in entries)]))
        for crc in glob.glob(f"{bronze}/_spark_metadata/.0.crc"):
            os.remove(crc)
        for n in (2, 3, 4):
            run = land_run(transactions({"transaction_id": n}), raw, f"run_{n}")
            if n == 3:
                for file in glob.glob(f"{run}/*"):
                    os.utime(file, (time.time() - years,) * 2)
            ingest_new_runs(spark, raw, bronze, checkpoint)
    finally:
        spark.conf.unset(interval)
    assert glob.glob(f"{bronze}/_spark_metadata/*.compact")
    assert bronze_ids(spark, bronze) == [1, 2, 3, 4]


def test_a_backlog_is_split_into_batches(spark, transactions, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    for n in range(5):
        land_run(transactions({"transaction_id": n}).coalesce(1), raw, f"run_{n}")
    query = ingest_new_runs(spark, raw, bronze, checkpoint, max_files_per_trigger=2)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 3
    assert bronze_ids(spark, bronze) == [0, 1, 2, 3, 4]


def test_a_failed_batch_is_repeated_whole(spark, transactions, tmp_path):
    """A batch that breaks off after writing some files leaves no trace in bronze."""
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    land_run(transactions({"transaction_id": 1}), raw, "run_1")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    rows = transactions(*[{"transaction_id": 10 + n} for n in range(8)])
    run = land_run(rows.repartition(4), raw, "run_2")
    broken = sorted(glob.glob(f"{run}/*.parquet"))[-1]
    content = open(broken, "rb").read()
    with open(broken, "wb") as file:
        file.write(content[:50])
    with pytest.raises(StreamingQueryException):
        ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1]
    with open(broken, "wb") as file:
        file.write(content)
    for crc in glob.glob(f"{run}/.*.crc"):
        os.remove(crc)
    ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1, *range(10, 18)]


def test_nothing_landed_yet(spark, transactions, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    ingest_new_runs(spark, raw, bronze, checkpoint)
    land_run(transactions({"transaction_id": 1}), raw, "run_1")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    assert bronze_ids(spark, bronze) == [1]


def test_schema_drift_within_a_stream(spark, transactions, tmp_path):
    raw, bronze, checkpoint = (str(tmp_path / name) for name in ("raw", "bronze", "checkpoint"))
    narrow = transactions({"transaction_id": 1, "quantity": 4})
    land_run(narrow.withColumn("quantity", F.col("quantity").cast("int")), raw, "run_1")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    land_run(transactions({"transaction_id": 2}).drop("city"), raw, "run_2")
    ingest_new_runs(spark, raw, bronze, checkpoint)
    rows = {r.transaction_id: r for r in read_table(spark, bronze, BRONZE_SCHEMA).collect()}
    assert (rows[1].quantity, rows[2].city) == (4, None)


def test_incremental_equals_full(spark, small_dir, tmp_path):
    full, step = LayerPaths.under(str(tmp_path / "full")), LayerPaths.under(str(tmp_path / "step"))
    rows = retail_view(spark, small_dir)
    for status in ("Delivered", "Cancelled", "Returned"):
        land_run(rows.filter(F.col("order_status") == status), full.raw, status)
        ingest_new_runs(spark, full.raw, step.bronze, str(tmp_path / "checkpoint"))
    raw_to_bronze(spark, full.raw, full.bronze)
    for paths in (full, step):
        bronze_to_silver(spark, paths.bronze, paths.silver, paths.quarantine)
        silver_to_gold(spark, paths.silver, paths.gold)
    for mart, schema in GOLD_SCHEMAS.items():
        assert sorted_rows(read_table(spark, f"{full.gold}/{mart}", schema)) == sorted_rows(
            read_table(spark, f"{step.gold}/{mart}", schema)
        )
