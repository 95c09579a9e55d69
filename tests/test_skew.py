"""One key holding a third of all rows, through the joins and through the whole pipeline."""

from __future__ import annotations

from collections import Counter
from contextlib import contextmanager

import pytest
from conftest import TESTDATA, sorted_rows
from pyspark.sql import functions as F

from ledgerloom.operators import clean_silver, mart_rollup, marts_from_rollup, split_quality
from ledgerloom.plans import LayerPaths, run_pipeline
from ledgerloom.schema import GOLD_SCHEMAS, RAW_SCHEMA, SILVER_SCHEMA
from ledgerloom.sources import generate_transactions, read_table, retail_view
from ledgerloom.sources.retail_view import TABLES


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): value for key, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """The tables with a third of the order lines on one part."""
    root = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        df = spark.read.parquet(f"{TESTDATA}/sf0.01/{name}.parquet")
        if name == "lineitem":
            hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(3)) == 0
            df = df.withColumn("l_partkey", F.when(hot, 5).otherwise(F.col("l_partkey")))
            df = df.repartition(16)
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def test_a_hot_part_is_split_by_the_join(spark, skewed_dir):
    expected = sorted_rows(retail_view(spark, skewed_dir))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="32KB",
        spark__sql__shuffle__partitions="16",
    ):
        df = retail_view(spark, skewed_dir)
        assert sorted_rows(df) == expected
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    assert len(expected) == spark.read.parquet(f"{skewed_dir}/lineitem.parquet").count()


def test_hot_id_hot_day_and_hot_city_through_the_pipeline(spark, tmp_path):
    n = 30_000
    hot = F.pmod(F.xxhash64("customer_id", "product_id"), F.lit(3)) == 0
    rows = generate_transactions(spark, n, seed=3, ingestion_date="2026-01-01", bad_rate=0.1)
    for name, value in {
        "transaction_id": 7,
        "order_date": "2024-02-29",
        "city": "Chicago",
        "state": "IL",
    }.items():
        rows = rows.withColumn(name, F.when(hot, F.lit(value)).otherwise(F.col(name)))
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA])
    paths = LayerPaths.under(str(tmp_path))
    counts = run_pipeline(spark, paths, incoming=rows, run_id="run_1")

    valid = split_quality(rows).valid.collect()
    ids = Counter(row.transaction_id for row in valid)
    assert ids[7] > 0.3 * len(valid)
    assert counts["silver_rows"] == len(ids)
    silver = read_table(spark, paths.silver, SILVER_SCHEMA)
    kept = silver.filter("transaction_id = 7").collect()
    assert len(kept) == 1
    # No value is NULL in the sorted columns before the first that differs.
    assert kept[0].ship_date == min(row.ship_date for row in valid if row.transaction_id == 7)
    expected = marts_from_rollup(mart_rollup(clean_silver(split_quality(rows).valid)))
    for mart, schema in GOLD_SCHEMAS.items():
        written = read_table(spark, f"{paths.gold}/{mart}", schema)
        assert sorted_rows(written) == sorted_rows(expected[mart])
