from __future__ import annotations

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from ledgerloom import queries
from ledgerloom.operators import column_profiles, describe_profiles, merge_profiles, profile_drift
from ledgerloom.operators.sketches import DISTINCT_ERROR, RANK_ERROR


@pytest.fixture(scope="module")
def runs(spark):
    """Three runs of uniform numbers, the last one shifted, with few and many distinct texts."""
    ids = spark.range(0, 60_000, 1, 6)
    run = (F.col("id") % 3).alias("run")
    return ids.select(
        F.concat(F.lit("r"), run).alias("run"),
        (F.pmod(F.xxhash64("id"), F.lit(10_000)) + F.when(run == 2, 3_000).otherwise(0)).alias("n"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("few"),
        F.col("id").cast("string").alias("many"),
    )


def by_name(df):
    return {(r["run"], r["column"]): r for r in df.collect()}


def test_errors_stay_within_their_bounds(spark, runs):
    found = by_name(describe_profiles(column_profiles(runs, ["n", "few", "many"], by="run"), (0.0, 0.1, 0.5, 0.9, 1.0)))
    assert len(found) == 9
    for run in ("r0", "r1", "r2"):
        rows = runs.where(F.col("run") == run)
        for column in ("n", "few", "many"):
            exact = rows.agg(F.count("*"), F.count(column), F.count_distinct(column)).first()
            r = found[run, column]
            assert (r["rows"], r["known"]) == tuple(exact[:2])
            assert abs(r["distinct_values"] - exact[2]) <= max(1, DISTINCT_ERROR * exact[2])
        values = sorted(r["n"] for r in rows.collect())
        for rank, q in zip((0.0, 0.1, 0.5, 0.9, 1.0), found[run, "n"]["quantiles"], strict=True):
            below = sum(v < q for v in values) / len(values)
            upto = sum(v <= q for v in values) / len(values)
            assert below - RANK_ERROR <= rank <= upto + RANK_ERROR
        assert found[run, "few"]["quantiles"] is None


def test_merged_runs_are_the_profile_of_all_rows(spark, runs):
    merged = by_name(describe_profiles(merge_profiles(column_profiles(runs, ["n", "few", "many"], by="run"))))
    whole = by_name(describe_profiles(column_profiles(runs, ["n", "few", "many"])))
    assert merged.keys() == whole.keys()
    for key, r in merged.items():
        # The same registers, whichever way they were filled.
        assert (r["rows"], r["known"], r["distinct_values"]) == (whole[key]["rows"], whole[key]["known"], whole[key]["distinct_values"])
    for a, b in zip(merged[None, "n"]["quantiles"], whole[None, "n"]["quantiles"], strict=True):
        assert abs(a - b) <= 4 * RANK_ERROR * 13_000


def test_drift_shows_the_shifted_run_only(spark, runs):
    profiles = column_profiles(runs, ["n", "few"], by="run")
    base = profiles.where("run = 'r0'")
    drift = by_name(profile_drift(profiles, base))
    assert drift["r0", "n"]["distance"] < 0.05
    assert drift["r1", "n"]["distance"] < 0.05
    assert abs(drift["r2", "n"]["distance"] - 0.3) < 0.05
    assert drift["r2", "few"]["distance"] is None and abs(drift["r2", "few"]["null_share_change"]) < 0.01
    assert abs(drift["r1", "few"]["distinct_ratio"] - 1) < 0.01


def test_nulls_nan_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, float("nan")), ("a", None, float("nan")), (None, None, 1.0)], "run string, x double, y double")
    found = by_name(describe_profiles(column_profiles(df, ["x", "y"], by="run")))
    assert (found["a", "x"]["known"], found["a", "x"]["distinct_values"], found["a", "x"]["quantiles"]) == (0, 0, None)
    assert (found["a", "y"]["known"], found["a", "y"]["quantiles"]) == (2, None)
    assert found[None, "y"]["quantiles"] == [1.0] * 5
    assert column_profiles(df.limit(0), ["x"], by="run").collect() == []
    merged = by_name(describe_profiles(merge_profiles(column_profiles(df, ["x", "y"], by="run"))))
    assert merged[None, "x"]["quantiles"] is None and merged[None, "y"]["rows"] == 3
    drift = by_name(profile_drift(column_profiles(df, ["x", "y"], by="run"), merge_profiles(column_profiles(df, ["x", "y"], by="run"))))
    assert drift["a", "y"]["distance"] is None and drift["a", "x"]["distinct_ratio"] is None


def test_rows_are_aggregated_before_the_shuffle(runs):
    plan = plan_text(column_profiles(runs, ["n"], by="run"))
    assert plan.count("partial_hll_sketch_agg") and plan.count("partial_kll_sketch_agg_double")


def test_values_are_counted_once_for_all_runs(spark, transactions):
    rows = transactions(
        {"order_status": "a", "quantity": 3, "unit_price": float("nan")}, {"order_status": "a", "quantity": 3, "payment_type": None},
        {"order_status": "b", "quantity": 3, "transaction_id": None}, {"order_status": None, "quantity": None},
    )
    counts = queries._value_counts(rows, column_profiles(rows, queries.PROFILED, by="order_status"))
    found = {(r["run"], r["text"]): (r["number"], r["times"]) for r in counts.where("column = 'quantity'").collect()}
    assert found == {("all", "3"): (3.0, 3), ("all", None): (None, 1), ("a", "3"): (3.0, 2), ("b", "3"): (3.0, 1)}
    assert counts.where("column = 'payment_type' and number is not null").count() == 0
    assert counts.groupBy("run", "column", "text").count().where("count > 1").count() == 0
    prices = {r["text"]: r["times"] for r in counts.where("column = 'unit_price' and run = 'a'").collect()}
    assert prices == {"NaN": 1, "1.0": 1}
