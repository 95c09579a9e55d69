from __future__ import annotations

import glob
import math
import os
from types import SimpleNamespace

import pytest
from conftest import plan_text, sorted_rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.operators import (
    city_revenue,
    clean_silver,
    daily_sales_metrics,
    dq_report,
    product_performance,
    split_quality,
)
from ledgerloom.plans import (
    LayerPaths,
    bronze_to_silver,
    land,
    raw_to_bronze,
    run_pipeline,
    session_settings,
    silver_to_gold,
)
from ledgerloom.plans import jobs
from ledgerloom.plans.paths import check_disjoint
from ledgerloom.schema import BRONZE_SCHEMA, GOLD_SCHEMAS, SILVER_SCHEMA
from ledgerloom.sources import (
    land_run,
    quarantine,
    read_quarantine_csv,
    read_raw,
    read_table,
    retail_view,
    scratch_path,
    write_parquet,
)
from ledgerloom.streaming import ingest_new_runs

MARTS = {
    "daily_sales_metrics": daily_sales_metrics,
    "product_performance": product_performance,
    "city_revenue": city_revenue,
}


@pytest.fixture(scope="module")
def layers(spark, small_dir, tmp_path_factory):
    paths = LayerPaths.under(str(tmp_path_factory.mktemp("lake")))
    counts = run_pipeline(spark, paths, incoming=retail_view(spark, small_dir), run_id="run_1")
    return paths, counts


def test_counts(layers):
    assert layers[1] == {
        "landed_rows": 6000,
        "bronze_rows": 6000,
        "raw_rows": 6000,
        "valid_rows": 5134,
        "quarantine_rows": 632,
        "indeterminate_rows": 234,
        "quantity_not_positive": 88,
        "age_below_min": 267,
        "age_above_max": 165,
        "price_not_positive": 127,
        "silver_rows": 3977,
    }


def pipeline_cities(spark, root, rows):
    paths = LayerPaths.under(root)
    run_pipeline(spark, paths, incoming=rows, run_id="run_1")
    city = read_table(spark, f"{paths.gold}/city_revenue", GOLD_SCHEMAS["city_revenue"])
    return {row["city"]: tuple(row)[2:] for row in city.collect()}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_beyond_a_bigint_of_cents(spark, transactions, tmp_path, ansi):
    rows = transactions(*[{"transaction_id": n, "unit_price": 6e16} for n in (1, 2)])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert pipeline_cities(spark, str(tmp_path), rows) == {"Chicago": (1.2e17, 2, 6e16)}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_amounts_without_cents_show_in_their_groups_alone(spark, transactions, tmp_path):
    prices = {"A": [1.0, float("nan"), 2.0], "B": [1.0, float("inf")], "C": [1e300, 5.0], "D": [1.0, 2.0], "E": [2e18, 0.25]}
    rows = [{"transaction_id": 10 * ord(city) + k, "city": city, "unit_price": p} for city, ps in prices.items() for k, p in enumerate(ps)]
    rows.append({"transaction_id": 6, "city": "D", "discount_pct": None})
    found = pipeline_cities(spark, str(tmp_path), transactions(*rows))
    assert all(math.isnan(x) for x in (found["A"][0], found["A"][2])) and found["A"][1] == 3
    assert found["B"] == (math.inf, 2, math.inf)
    assert found["C"] == (1e300, 2, 5e299)
    assert found["D"] == (3.0, 3, 1.5)
    assert found["E"] == (2e18 + 0.25, 2, 1e18)


def test_layers_equal_the_operators(spark, small_dir, layers):
    paths, _ = layers
    rows = retail_view(spark, small_dir)
    parts = split_quality(rows)
    silver = clean_silver(parts.valid)
    assert sorted_rows(read_table(spark, paths.bronze, BRONZE_SCHEMA)) == sorted_rows(rows)
    assert sorted_rows(read_table(spark, paths.silver, SILVER_SCHEMA)) == sorted_rows(silver)
    assert sorted_rows(read_quarantine_csv(spark, paths.quarantine)) == sorted_rows(
        parts.quarantine
    )
    for mart, build in MARTS.items():
        written = read_table(spark, f"{paths.gold}/{mart}", GOLD_SCHEMAS[mart])
        assert sorted_rows(written) == sorted_rows(build(silver))


def test_gold_holds_the_marts_and_nothing_else(layers):
    names = [path.rsplit("/", 1)[1] for path in glob.glob(f"{layers[0].gold}/*")]
    assert sorted(names) == sorted(MARTS)


def test_a_rerun_gives_the_same_tables(spark, layers):
    paths, counts = layers
    before = sorted_rows(read_table(spark, paths.silver, SILVER_SCHEMA))
    assert {"landed_rows": 6000} | run_pipeline(spark, paths) == counts
    assert sorted_rows(read_table(spark, paths.silver, SILVER_SCHEMA)) == before


def test_a_second_run_is_added(spark, transactions, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    first = transactions({"transaction_id": 1}, {"transaction_id": 2, "quantity": 0})
    second = transactions({"transaction_id": 1, "quantity": 5}, {"transaction_id": 3})
    run_pipeline(spark, paths, incoming=first, run_id="run_1")
    counts = run_pipeline(spark, paths, incoming=second, run_id="run_2")
    assert (counts["bronze_rows"], counts["silver_rows"]) == (4, 2)
    silver = read_table(spark, paths.silver, SILVER_SCHEMA)
    assert sorted((r.transaction_id, r.quantity) for r in silver.collect()) == [(1, 1), (3, 1)]


def test_incoming_rows_need_a_run(spark, transactions, tmp_path):
    with pytest.raises(ValueError):
        run_pipeline(spark, LayerPaths.under(str(tmp_path)), incoming=transactions({}))


@pytest.mark.parametrize("bad, per_file", [(0, 10), (10, 10), (11, 10), (300, 4)])
def test_quarantine_files_are_bounded(spark, transactions, tmp_path, bad, per_file):
    paths = LayerPaths.under(str(tmp_path))
    rows = [{"transaction_id": n, "quantity": 0} for n in range(bad)] + [{"transaction_id": 1000}]
    write_parquet(transactions(*rows), paths.bronze)
    counts = bronze_to_silver(
        spark, paths.bronze, paths.silver, paths.quarantine, quarantine_rows_per_file=per_file
    )
    assert counts["quarantine_rows"] == bad
    written = read_quarantine_csv(spark, paths.quarantine)
    assert sorted(row.transaction_id for row in written.collect()) == list(range(bad))
    names = glob.glob(f"{paths.quarantine}/*.csv")
    assert names and all(len(open(name).readlines()) <= per_file + 1 for name in names)


def test_the_quarantine_is_filtered_and_written_where_it_is_scanned(spark, small_dir):
    bad = split_quality(retail_view(spark, small_dir)).quarantine
    assert not hasattr(quarantine, "MAX_REDISTRIBUTED_FILES")
    assert "REPARTITION" not in plan_text(bad) and "REBALANCE" not in plan_text(bad)


def test_an_empty_lake_gives_empty_layers(spark, transactions, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    counts = run_pipeline(spark, paths, incoming=transactions({}).filter("false"), run_id="run_1")
    assert set(counts.values()) == {0}
    for mart, schema in GOLD_SCHEMAS.items():
        assert read_table(spark, f"{paths.gold}/{mart}", schema).count() == 0


def test_jobs_refuse_to_write_where_they_read(spark, transactions, tmp_path):
    root = str(tmp_path)
    land_run(transactions({}), f"{root}/raw", "run_1")
    run = f"{root}/raw/run_1"
    relative = os.path.relpath(run, os.getcwd())
    with pytest.raises(ValueError):
        raw_to_bronze(spark, f"{root}/raw", run)
    with pytest.raises(ValueError):
        raw_to_bronze(spark, f"{root}/raw", f"{root}/x/../raw")
    for same in (f"{run}/", f"{root}/x/../raw/./run_1", relative, f"file:{run}"):
        with pytest.raises(ValueError):
            bronze_to_silver(spark, run, same, f"{root}/q")
    with pytest.raises(ValueError):
        bronze_to_silver(spark, run, f"{root}/s", f"{root}/s/q")
    with pytest.raises(ValueError):
        silver_to_gold(spark, run, root)
    assert dq_report(read_table(spark, run, BRONZE_SCHEMA)).first().raw_rows == 1


@pytest.mark.parametrize(
    "inputs, outputs, clash",
    [
        (["s3a://lake/raw"], ["s3a://lake/bronze"], False),
        (["s3a://lake/raw"], ["s3a://lake/raw2"], False),
        (["s3a://lake/raw"], ["hdfs://lake/raw"], False),
        (["s3a://lake/raw"], ["s3a://other/raw"], False),
        (["s3a://lake/raw/"], ["s3a://lake/raw"], True),
        (["s3a://lake/raw"], ["s3a://lake/x/../raw/y"], True),
        (["file:/lake/raw"], ["/lake/raw/x"], True),
        (["file:///lake/raw"], ["/lake//raw"], True),
        (["/lake/raw/x"], ["/lake/raw"], True),
        (["/lake/raw"], ["/lake/bronze/../raw"], True),
        (["/lake/raw"], ["/../lake/raw"], True),
        (["lake/raw"], [f"{os.getcwd()}/lake/raw"], True),
        ([], ["/lake/a", "/lake/a/b"], True),
    ],
)
def test_overlap(spark, inputs, outputs, clash):
    if clash:
        with pytest.raises(ValueError):
            check_disjoint(spark, inputs, outputs)
    else:
        check_disjoint(spark, inputs, outputs)


@pytest.mark.parametrize(
    "one, other, clash",
    [
        ("/lake/b", "hdfs://127.0.0.1:8020/lake/b", True),
        ("hdfs:///lake/b", "hdfs://127.0.0.1:8020/lake/b/c", True),
        ("hdfs:///lake/b", "/lake/b", True),
        ("/lake/b", "file:///lake/b", False),
        ("/lake/b", "hdfs://127.0.0.2:8020/lake/b", False),
    ],
)
def test_overlap_with_a_default_file_system(spark, one, other, clash):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "hdfs://127.0.0.1:8020")
    try:
        test_overlap(spark, [one], [other], clash)
    finally:
        conf.set("fs.defaultFS", before)


def test_the_scratch_table_goes_when_the_marts_are_written(spark, transactions, tmp_path, monkeypatch):
    shared, written = str(tmp_path / "shared"), []
    monkeypatch.setattr(jobs, "scratch_path", lambda spark, name: written.append(name) or f"{shared}/{name}")
    run_pipeline(spark, LayerPaths.under(str(tmp_path / "lake")), incoming=transactions({}), run_id="run_1")
    assert len(written) == 1 and os.listdir(shared) == []


def test_a_cluster_needs_a_shared_folder():
    def session(**conf):
        return SimpleNamespace(conf={key.replace("_", "."): value for key, value in conf.items()})

    for master in ("local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError):
            scratch_path(session(spark_master=master), "x")
    assert scratch_path(session(spark_master="yarn", spark_checkpoint_dir="hdfs:///tmp/"), "x") == "hdfs:///tmp/x"


def test_a_failed_landing_is_replaced(spark, transactions, tmp_path):
    raw = str(tmp_path / "raw")
    broken = transactions({}, {"quantity": 7}).withColumn(
        "city", F.when(F.col("quantity") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("city"))
    )
    with pytest.raises(Exception, match="broken"):
        land(broken, raw, "run_1")
    assert land(transactions({}, {"transaction_id": 2}), raw, "run_1") == {"landed_rows": 2}
    with pytest.raises(AnalysisException):
        land(transactions({}), raw, "run_1")
    assert read_raw(spark, raw).count() == 2


def test_a_streamed_bronze_is_not_overwritten(spark, transactions, tmp_path):
    paths = LayerPaths.under(str(tmp_path))
    land_run(transactions({}), paths.raw, "run_1")
    ingest_new_runs(spark, paths.raw, paths.bronze, f"{tmp_path}/checkpoint")
    with pytest.raises(ValueError):
        raw_to_bronze(spark, paths.raw, paths.bronze)
    assert read_table(spark, paths.bronze, BRONZE_SCHEMA).count() == 1


def test_settings_are_left_alone(spark, transactions, tmp_path):
    before = dict(spark.conf.getAll)
    paths = LayerPaths.under(str(tmp_path))
    run_pipeline(spark, paths, incoming=transactions({}), run_id="run_1")
    assert dict(spark.conf.getAll) == before


def test_settings_bound_what_a_task_reads_at_any_size():
    mib, tib = 2**20, 2**40
    small = session_settings(100 * mib, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * mib)
    blocks = {}
    for size, cores in ((100 * mib, 8), (tib, 1000), (10 * tib, 4000), (100 * tib, 8000), (1000 * tib, 8000)):
        found = session_settings(size, cores)
        assert found.keys() == small.keys() and found["spark.io.compression.codec"] == "zstd"
        partitions, split = int(found["spark.sql.shuffle.partitions"]), int(found["spark.sql.files.maxPartitionBytes"])
        assert size / partitions <= 1024 * mib and split <= 2048 * mib
        blocks[size] = partitions * -(-size // split)
    assert blocks[tib] < 0.2e9 and blocks[10 * tib] < 0.9e9 and blocks[100 * tib] < 5.3e9
