from __future__ import annotations

import uuid

import pytest
from conftest import sorted_rows
from pyspark.sql import functions as F

from ledgerloom.operators import clustered, dealt_evenly, dedup_transactions, files_by_extent
from ledgerloom.operators.layout import cluster_key, range_bounds
from ledgerloom.sources import drop_bucketed, exchanges, write_bucketed, write_parquet
from ledgerloom.sources.files import children


@pytest.fixture
def table_name(spark):
    name = f"layout_{uuid.uuid4().hex}"
    yield name
    for suffix in ("a", "b"):
        drop_bucketed(spark, f"{name}_{suffix}")


def test_what_follows_a_bucketed_table_moves_no_rows(spark, transactions, tmp_path, table_name):
    rows = transactions(*[{"transaction_id": k % 40 if k % 9 else None, "quantity": k} for k in range(200)])
    a = write_bucketed(rows, f"{table_name}_a", str(tmp_path / "a"), buckets=8)
    b = write_bucketed(rows.select("transaction_id", F.col("quantity").alias("q")), f"{table_name}_b", str(tmp_path / "b"), buckets=8)
    assert sorted_rows(a) == sorted_rows(rows.select(*a.columns))
    once = dedup_transactions(a)
    assert exchanges(once) == 0 and exchanges(dedup_transactions(rows)) == 1
    assert sorted_rows(once) == sorted_rows(dedup_transactions(rows))
    joined = once.hint("merge").join(b.hint("merge"), "transaction_id")
    assert exchanges(joined) == 0
    assert joined.count() == rows.where("transaction_id is not null").count()
    assert exchanges(a.groupBy("transaction_id").count()) == 0
    files = [f for f in children(spark, str(tmp_path / "a")) if f.endswith(".parquet")]
    assert 1 < len(files) <= 8


def test_a_bucketed_table_can_be_replaced(spark, transactions, tmp_path, table_name):
    for n in (3, 5):
        found = write_bucketed(transactions(*[{"transaction_id": k} for k in range(n)]), f"{table_name}_a", str(tmp_path / "a"), buckets=4)
        assert found.count() == n


@pytest.fixture(scope="module")
def points(spark):
    ids = spark.range(0, 40_000, 1, 4)
    x, y = F.pmod(F.xxhash64("id"), F.lit(1000)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))
    return ids.select("id", F.when(F.col("id") % 50 != 0, x).alias("x"), F.format_string("c%03d", y).alias("y"))


def needed(table, x, y):
    wanted = (F.col("low_x") < x[1]) & (F.col("high_x") >= x[0]) & (F.col("low_y") <= y[1]) & (F.col("high_y") >= y[0])
    return files_by_extent(table, ["x", "y"]).agg(F.count(F.lit(1)), F.count_if(wanted), F.min("rows"), F.max("rows"), F.sum("rows")).first()


def test_filters_on_either_column_leave_files_out(spark, points, tmp_path):
    write_parquet(clustered(points, ["x", "y"], 64), str(tmp_path / "z"))
    table = spark.read.schema(points.schema).parquet(str(tmp_path / "z"))
    assert sorted_rows(table) == sorted_rows(points)
    files, both, least, most, rows = needed(table, (100, 150), ("c700", "c750"))
    assert files == 64 and rows == 40_000 and both <= 10
    assert most < 3 * 40_000 / 64 and least > 0
    assert needed(table, (100, 110), ("c000", "c999"))[1] <= 24
    assert needed(table, (0, 1000), ("c300", "c310"))[1] <= 24


def test_a_hot_value_is_several_files(spark, tmp_path):
    hot = spark.range(0, 12_000, 1, 4).select("id", F.lit(7).alias("x"), F.lit("a").alias("y"))
    write_parquet(clustered(hot, ["x", "y"], 12), str(tmp_path / "z"))
    _, _, least, most, rows = needed(spark.read.schema(hot.schema).parquet(str(tmp_path / "z")), (0, 10), ("a", "a"))
    assert rows == 12_000 and most < 3_000


def test_nulls_nan_and_empty_tables(spark):
    df = spark.createDataFrame([(None, float("nan")), (1, None), (2, 0.5), (None, None)], "x int, y double")
    assert sorted_rows(clustered(df, ["x", "y"], 2)) == sorted_rows(df) or clustered(df, ["x", "y"], 2).count() == 4
    assert clustered(df.limit(0), ["x", "y"], 2).count() == 0
    assert range_bounds(df.limit(0), ["x"]) == {"x": []}
    keys = df.select("x", cluster_key({"x": [1, 2]}, 2).alias("k")).collect()
    assert [(r["x"], r["k"]) for r in keys] == [(None, 0), (1, 1), (2, 2), (None, 0)]


def test_extents_do_not_sort_all_rows(spark, points, tmp_path):
    write_parquet(points.repartition(3), str(tmp_path / "p"))
    found = files_by_extent(spark.read.schema(points.schema).parquet(str(tmp_path / "p")), ["x", "y"])
    lines = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
    scans = [k for k, line in enumerate(lines) if "FileScan" in line]
    assert scans and all("HashAggregate" in next(line for line in reversed(lines[:k]) if "Aggregate" in line) for k in scans)
    table = spark.read.parquet(str(tmp_path / "p")).select("*", F.col("_metadata.file_path").alias("file")).toPandas()
    by = table.groupby("file")
    expected = [(f, len(t), t.x.min(), t.x.max(), t.y.min(), t.y.max()) for f, t in by]
    assert sorted_rows(found) == sorted(expected)


def test_extents_of_files_without_known_values(spark, tmp_path):
    write_parquet(spark.range(0, 6, 1, 2).select("id", F.lit(None).cast("string").alias("y")), str(tmp_path / "p"))
    found = files_by_extent(spark.read.parquet(str(tmp_path / "p")), ["y", "id"])
    assert found.columns == ["file", "rows", "low_y", "high_y", "low_id", "high_id"]
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(3, None, None, 0, 2), (3, None, None, 3, 5)]


def test_dealt_evenly_keeps_rows_and_sorts_none(spark):
    df = spark.range(0, 9_000, 1, 4).select(F.lit(1).alias("same"))
    dealt = dealt_evenly(df, 9)
    assert dealt.columns == ["same"] and dealt.rdd.getNumPartitions() == 9
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 9_000 and max(sizes) < 1_300
