from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import plan_text, sorted_rows
from pyspark.sql import functions as F

from ledgerloom.operators import (
    city_revenue,
    clean_silver,
    daily_sales_metrics,
    mart_rollup,
    marts_from_rollup,
    product_performance,
    split_quality,
    with_total_amount,
)
from ledgerloom.schema import GOLD_SCHEMAS, SILVER_SCHEMA
from ledgerloom.sources import read_table, retail_view, write_parquet

MARTS = {
    "daily_sales_metrics": daily_sales_metrics,
    "product_performance": product_performance,
    "city_revenue": city_revenue,
}


@pytest.fixture(scope="module")
def silver(spark, small_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "table")
    write_parquet(clean_silver(split_quality(retail_view(spark, small_dir)).valid), path)
    return read_table(spark, path, SILVER_SCHEMA)


def cents_of(row) -> int | None:
    if None in (row.quantity, row.unit_price, row.discount_pct):
        return None
    amount = float(row.quantity) * row.unit_price * (1 - row.discount_pct / 100)
    return int(Decimal(repr(amount)).quantize(Decimal("0.01"), ROUND_HALF_UP) * 100)


def brute_force(rows, keys):
    """(cents, units, orders, mean) per group, in Python integers and decimals."""
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[key] for key in keys)].append(row)
    out = {}
    for key, members in groups.items():
        cents = [c for c in map(cents_of, members) if c is not None]
        mean = None
        if cents:
            exact = Decimal(sum(cents)) / len(cents)
            mean = float(exact.quantize(Decimal(1), ROUND_HALF_UP)) / 100
        out[key] = (
            sum(cents) / 100 if cents else None,
            sum(row.quantity for row in members if row.quantity is not None),
            sum(row.transaction_id is not None for row in members),
            mean,
        )
    return out


def test_marts_equal_brute_force(silver):
    rows = silver.collect()
    days = brute_force(rows, ["order_date"])
    assert {(r[0],): tuple(r)[1:] for r in daily_sales_metrics(silver).collect()} == {
        key: (revenue, orders, mean) for key, (revenue, _, orders, mean) in days.items()
    }
    kinds = brute_force(rows, ["product_category"])
    assert {(r[0],): tuple(r)[1:] for r in product_performance(silver).collect()} == {
        key: (revenue, units, orders) for key, (revenue, units, orders, _) in kinds.items()
    }
    places = brute_force(rows, ["city", "state"])
    assert {tuple(r)[:2]: tuple(r)[2:] for r in city_revenue(silver).collect()} == {
        key: (revenue, orders, mean) for key, (revenue, _, orders, mean) in places.items()
    }


@pytest.mark.parametrize("mart", MARTS)
def test_schema_and_known_size(silver, mart):
    df = MARTS[mart](silver)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in GOLD_SCHEMAS[mart]
    ]
    sizes = {"daily_sales_metrics": 1003, "product_performance": 6, "city_revenue": 25}
    assert df.count() == sizes[mart]


@pytest.mark.parametrize("mart", MARTS)
def test_partitioning_does_not_matter(silver, mart):
    results = [sorted_rows(MARTS[mart](silver.repartition(n))) for n in (1, 8, 64)]
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("mart", MARTS)
def test_one_pass_gives_the_same_marts(silver, mart):
    once = marts_from_rollup(mart_rollup(silver))[mart]
    single = MARTS[mart](silver)
    assert once.columns == single.columns
    assert sorted_rows(once) == sorted_rows(single)


def test_exact_money_equals_rounded_doubles_but_for_ties(silver):
    """Summing doubles gives the same revenue, and means that differ only in tied cents."""
    amount = F.col("total_amount")
    doubles = with_total_amount(silver).groupBy("order_date").agg(
        F.round(F.sum(amount), 2).alias("revenue"), F.round(F.avg(amount), 2).alias("mean")
    )
    measures = mart_rollup(silver).filter("mart = 'daily_sales_metrics'").select(
        "order_date", "cents", "amounts"
    )
    both = daily_sales_metrics(silver).join(doubles, "order_date").join(measures, "order_date")
    assert both.count() == 1003
    assert both.filter("not (total_revenue <=> revenue)").count() == 0
    tied = "2 * pmod(cents, amounts) = amounts"
    assert both.filter(f"avg_order_value <> mean and not ({tied})").count() == 0
    assert both.filter("avg_order_value <> mean").count() < both.filter(tied).count()
    assert both.filter("abs(avg_order_value - mean) > 0.011").count() == 0


def test_marts_agree_with_each_other(silver):
    def totals(df, revenue, orders):
        cents = F.sum(F.rint(F.col(revenue) * 100).cast("bigint"))
        return tuple(df.agg(cents, F.sum(orders)).first())

    day = totals(daily_sales_metrics(silver), "total_revenue", "total_orders")
    kind = totals(product_performance(silver), "category_revenue", "order_count")
    place = totals(city_revenue(silver), "city_revenue", "order_count")
    assert day == kind == place


def test_null_amounts_and_null_ids(transactions):
    rows = transactions(
        {"transaction_id": 1, "quantity": 2, "unit_price": 10.0, "discount_pct": None},
        {"transaction_id": 2, "unit_price": 5.0, "discount_pct": 10.0},
        {"transaction_id": None, "unit_price": 1.0},
    )
    amounts = [row.total_amount for row in with_total_amount(rows).collect()]
    assert amounts == [None, 4.5, 1.0]
    assert sorted_rows(daily_sales_metrics(rows)) == [("2024-01-01", 5.5, 2, 2.75)]
    assert sorted_rows(product_performance(rows)) == [("Sports", 5.5, 4, 2)]
    assert sorted_rows(city_revenue(rows)) == [("Chicago", "IL", 5.5, 2, 2.75)]


def test_null_keys_are_groups_of_their_own(transactions):
    rows = transactions(
        {"order_date": None, "product_category": None, "city": None, "state": None},
        {"order_date": None, "product_category": None, "city": "Chicago", "state": None},
        {},
    )
    for mart, build in MARTS.items():
        assert sorted_rows(build(rows)) == sorted_rows(marts_from_rollup(mart_rollup(rows))[mart])
    assert (None, 2.0, 2, 1.0) in sorted_rows(daily_sales_metrics(rows))
    assert (None, None, 1.0, 1, 1.0) in sorted_rows(city_revenue(rows))


def test_groups_without_any_amount(transactions):
    rows = transactions({"discount_pct": None}, {"quantity": None})
    assert sorted_rows(daily_sales_metrics(rows)) == [("2024-01-01", None, 2, None)]


def test_means_of_negative_amounts(transactions):
    rows = transactions(
        {"transaction_id": 1, "unit_price": 0.05, "discount_pct": 200.0},
        {"transaction_id": 2, "unit_price": 0.02, "discount_pct": 200.0},
    )
    assert sorted_rows(daily_sales_metrics(rows)) == [("2024-01-01", -0.07, 2, -0.04)]


def test_each_mart_reads_its_columns_and_combines_before_the_shuffle(silver):
    plan = plan_text(daily_sales_metrics(silver))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert (
        "ReadSchema: struct<transaction_id:bigint,order_date:string,quantity:bigint,"
        "unit_price:double,discoun" in physical
    )
    assert physical.index("Exchange hashpartitioning(order_date") < physical.index("partial_sum")


def test_one_pass_scans_silver_once(silver):
    plan = plan_text(mart_rollup(silver))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("FileScan parquet") == 1
    assert physical.count("Exchange") == 1
    # The amount is rounded below the expansion into grouping sets: once per row.
    assert physical.index("Expand") < physical.index("round(")
    assert physical.index("Exchange") < physical.index("partial_sum")
