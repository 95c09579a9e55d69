from __future__ import annotations

import pytest
from conftest import plan_text, sorted_rows
from pyspark.sql import functions as F

from ledgerloom.operators import dq_report
from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources import generate_transactions, generator, land_run, read_raw

DATE = "2026-01-01"


def make(spark, n=2000, **options):
    return generate_transactions(spark, n, **({"seed": 1, "ingestion_date": DATE} | options))


def test_schema_and_count(spark):
    df = make(spark, 1234)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in RAW_SCHEMA
    ]
    assert df.count() == 1234


def test_rows_do_not_depend_on_partitions(spark):
    one, many = (sorted_rows(make(spark, num_partitions=n)) for n in (1, 7))
    assert one == many


def test_partitions_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(generator, "ROWS_PER_PARTITION", 100)
    df = make(spark, 1001).withColumn("partition", F.spark_partition_id())
    counts = [row["count"] for row in df.groupBy("partition").count().collect()]
    assert sum(counts) == 1001 and max(counts) <= 100


def test_the_seed_matters(spark):
    assert sorted_rows(make(spark)) != sorted_rows(make(spark, seed=2))


def test_domains_are_filled_evenly(spark):
    n = 50_000
    df = make(spark, n).cache()
    distinct = df.agg(
        *[
            F.count_distinct(name).alias(name)
            for name in ("order_date", "product_category", "city", "quantity", "customer_age")
        ]
    ).first()
    assert tuple(distinct) == (1096, 4, 5, 9, 90)
    for name, size in {
        "product_category": 4,
        "city": 5,
        "gender": 5,
        "payment_type": 5,
        "order_status": 3,
        "quantity": 9,
    }.items():
        counts = [row["count"] for row in df.groupBy(name).count().collect()]
        assert len(counts) == size
        expected = n / size
        assert all(abs(count - expected) < 6 * expected**0.5 for count in counts), name
    edges = df.agg(
        F.min("discount_pct"), F.max("discount_pct"), F.min("order_date"), F.max("order_date")
    ).first()
    assert edges[0] < 0.05 and edges[1] > 49.95
    assert edges[2:] == ("2023-01-01", "2025-12-31")
    ages = df.agg(F.avg("customer_age"), F.corr("customer_age", "quantity")).first()
    assert abs(ages[0] - 54.5) < 1 and abs(ages[1]) < 0.03
    df.unpersist()


def test_only_low_ages_are_bad_by_default(spark):
    report = dq_report(make(spark, 20_000)).first().asDict()
    assert report["indeterminate_rows"] == 0
    assert report["quarantine_rows"] == report["age_below_min"]
    assert abs(report["age_below_min"] / 20_000 - 5 / 90) < 0.01


def test_defects_break_every_rule(spark):
    report = dq_report(make(spark, 20_000, bad_rate=0.3)).first().asDict()
    assert all(count > 500 for count in report.values())


@pytest.mark.parametrize("rows, per_file", [(250, 100), (99, 100)])
def test_landing_keeps_the_remainder(spark, tmp_path, rows, per_file):
    raw = str(tmp_path / "raw")
    land_run(make(spark, rows), raw, "run_1", rows_per_file=per_file)
    assert read_raw(spark, raw).count() == rows


def test_generation_is_one_projection(spark):
    plan = plan_text(make(spark))
    assert "Exchange" not in plan
    assert "Python" not in plan
