from __future__ import annotations

import glob

import pytest
from conftest import sorted_rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources import (
    land_run,
    read_quarantine_csv,
    read_raw,
    read_table,
    scratch_path,
    write_parquet,
    write_quarantine_csv,
)


def test_runs_are_read_together(spark, transactions, tmp_path):
    raw = str(tmp_path / "raw")
    land_run(transactions({"transaction_id": 1}), raw, "20260101_000000")
    land_run(transactions({"transaction_id": 2}), raw, "20260101_001000")
    out = read_raw(spark, raw)
    assert out.schema == RAW_SCHEMA
    assert sorted(row.transaction_id for row in out.collect()) == [1, 2]


def test_a_run_is_landed_once(spark, transactions, tmp_path):
    raw = str(tmp_path / "raw")
    land_run(transactions({}), raw, "run")
    with pytest.raises(AnalysisException):
        land_run(transactions({}), raw, "run")
    assert read_raw(spark, raw).count() == 1


def test_no_run_is_an_error_and_an_empty_table_is_not(spark, transactions, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(AnalysisException):
        read_raw(spark, str(tmp_path / "raw"))
    assert read_table(spark, str(tmp_path / "raw"), RAW_SCHEMA).count() == 0


def test_nested_files_need_recursion(spark, transactions, tmp_path):
    raw = str(tmp_path / "raw")
    land_run(transactions({"transaction_id": 1}), raw, "a")
    transactions({"transaction_id": 2}).write.parquet(f"{raw}/b/deeper")
    assert read_raw(spark, raw).count() == 1
    assert read_raw(spark, raw, recursive=True).count() == 2


def test_files_of_other_ages(spark, transactions, tmp_path):
    raw = str(tmp_path / "raw")
    land_run(transactions({"transaction_id": 1}), raw, "now")
    older = transactions({"transaction_id": 2, "quantity": 3})
    land_run(older.withColumn("quantity", F.col("quantity").cast("int")), raw, "narrow")
    land_run(transactions({"transaction_id": 3}).drop("payment_type"), raw, "missing")
    land_run(transactions({"transaction_id": 4}).withColumn("more", F.lit(1)), raw, "extra")
    renamed = transactions({"transaction_id": 5}).withColumnRenamed("city", "CITY")
    land_run(renamed, raw, "other_case")
    out = read_raw(spark, raw)
    assert out.schema == RAW_SCHEMA
    rows = {row.transaction_id: row for row in out.collect()}
    assert rows[2].quantity == 3
    assert [rows[n].payment_type for n in (1, 3, 4)] == ["Card", None, "Card"]
    assert rows[5].city == "Chicago"


@pytest.mark.parametrize("kind", ["string", "double"])
def test_a_column_of_another_kind_fails(spark, transactions, tmp_path, kind):
    raw = str(tmp_path / "raw")
    land_run(transactions({}).withColumn("quantity", F.col("quantity").cast(kind)), raw, "run")
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH"):
        read_raw(spark, raw).collect()


def test_no_row_is_lost_to_file_limits(spark, transactions, tmp_path):
    raw = str(tmp_path / "raw")
    rows = transactions(*[{"transaction_id": n} for n in range(25)]).coalesce(1)
    run = land_run(rows, raw, "run", rows_per_file=10)
    sizes = [spark.read.parquet(file).count() for file in glob.glob(f"{run}/*.parquet")]
    assert sorted(sizes) == [5, 10, 10]


def test_a_table_is_replaced(spark, transactions, tmp_path):
    path = str(tmp_path / "table")
    write_parquet(transactions({}, {}), path)
    write_parquet(transactions({"transaction_id": 9}), path)
    out = read_table(spark, path, RAW_SCHEMA).collect()
    assert [row.transaction_id for row in out] == [9]


AWKWARD = [
    {"gender": " male "},
    {"gender": ""},
    {"gender": None, "quantity": None, "unit_price": None},
    {"gender": "a,b"},
    {"gender": 'q"x'},
    {"gender": 'back\\slash"quote\\'},
    {"gender": "line\nbreak\r\nagain"},
    {"gender": "\ttab\t"},
    {"gender": "null"},
    {"gender": "#comment"},
    {"gender": "näïve ☃"},
    {"transaction_id": None, "gender": "'"},
    {"customer_id": "", "city": "", "unit_price": 0.1 + 0.2, "discount_pct": 1e-300},
    {"unit_price": -1e300, "quantity": -(2**63)},
]


@pytest.mark.parametrize("options", [{}, {"rows_per_file": 5}])
def test_quarantine_keeps_the_evidence(spark, transactions, tmp_path, options):
    path = str(tmp_path / "bad")
    rows = transactions(*AWKWARD)
    write_quarantine_csv(rows, path, **options)
    back = read_quarantine_csv(spark, path)
    assert back.schema == RAW_SCHEMA
    assert sorted_rows(back) == sorted_rows(rows)
    by_file = back.groupBy(F.input_file_name()).count().collect()
    assert all(row["count"] <= options.get("rows_per_file", 14) for row in by_file)


def test_quarantine_scan_stays_parallel(spark, transactions, tmp_path):
    """Each task writes the rows that it has scanned."""
    spread = transactions(*[{"transaction_id": n} for n in range(40)]).repartition(4)
    path = str(tmp_path / "bad")
    write_quarantine_csv(spread.withColumn("city", F.spark_partition_id().cast("string")), path)
    seen = {row.city for row in read_quarantine_csv(spark, path).collect()}
    assert seen == {"0", "1", "2", "3"}
    assert len(glob.glob(f"{path}/*.csv")) == 4


def test_quarantine_file_format(spark, transactions, tmp_path):
    path = str(tmp_path / "bad")
    rows = transactions({"gender": "", "city": None, "state": "a,b", "customer_id": 'q"x'})
    write_quarantine_csv(rows, path)
    header = ",".join(RAW_SCHEMA.fieldNames())
    lines = [open(file).read().splitlines() for file in glob.glob(f"{path}/*.csv")]
    assert all(each[0] == header for each in lines)
    (line,) = [line for each in lines for line in each[1:]]
    assert line == (
        '1,2024-01-01,2024-01-03,"q\\"x",30,"",PROD1,Sports,1,1.0,0.0,,"a,b",Card,'
        "Delivered,2026-01-01"
    )


def test_empty_quarantine_has_a_header(spark, transactions, tmp_path):
    path = str(tmp_path / "bad")
    write_quarantine_csv(transactions({}).filter("false"), path)
    texts = [open(file).read().strip() for file in glob.glob(f"{path}/*.csv")]
    assert texts == [",".join(RAW_SCHEMA.fieldNames())]
    assert read_quarantine_csv(spark, path).count() == 0


class FakeSession:
    def __init__(self, **conf):
        self.conf = {key.replace("__", "."): value for key, value in conf.items()}


def test_scratch_lies_in_the_shared_folder():
    session = FakeSession(spark__master="local[2]", spark__checkpoint__dir="/shared/")
    assert scratch_path(session, "x") == "/shared/x"


def test_scratch_of_a_local_session_without_one_is_new():
    session = FakeSession(spark__master="local[2]")
    assert scratch_path(session, "x") != scratch_path(session, "x")


def test_scratch_on_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        scratch_path(FakeSession(spark__master="yarn"), "x")
    on_cluster = FakeSession(spark__master="yarn", spark__checkpoint__dir="hdfs://shared/")
    assert scratch_path(on_cluster, "x") == "hdfs://shared/x"
