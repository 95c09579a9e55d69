from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import (
    amount_cents,
    cent_parts,
    cents_to_amount,
    gender_code,
    mean_amount,
    order_amount,
    round_cents,
    sum_cents,
)


def one_column(spark, values, kind):
    return spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")


def evaluated(df, column):
    return [row[0] for row in df.orderBy("n").select(column).collect()]


@pytest.mark.parametrize(
    "code, spellings",
    [
        ("M", ["M", "m", " male ", "Male", "MALE"]),
        ("F", ["F", "f", "female", "Female", "  FEMALE"]),
        ("Unknown", [None, "", " ", "X", "FEMALE\t", "Males"]),
    ],
)
def test_gender_code(spark, code, spellings):
    df = one_column(spark, spellings, "string")
    assert evaluated(df, gender_code(F.col("v"))) == [code] * len(spellings)


def test_amount_rounds_half_up_on_the_printed_value(spark):
    prices = [2.675, 1.005, 0.125, 0.135, 8.345, -1.005, 10.075]
    df = one_column(spark, prices, "double")
    amount = order_amount(F.lit(1).cast("bigint"), F.col("v"), F.lit(0.0))
    assert evaluated(df, amount) == [2.68, 1.01, 0.13, 0.14, 8.35, -1.01, 10.08]


def test_amount_applies_a_percentage_and_propagates_null(spark):
    df = spark.createDataFrame(
        [(1, 2, 10.0, None), (2, 1, 5.0, 10.0), (3, None, 1.0, 0.0), (4, 1, 10.0, 150.0)],
        "n int, q bigint, p double, d double",
    )
    amount = order_amount(F.col("q"), F.col("p"), F.col("d"))
    assert evaluated(df, amount) == [None, 4.5, None, -5.0]


def test_cents_of_what_is_no_amount_are_null(spark):
    values = [1.1, -0.29, 4.35, 1234567.89, float("nan"), float("inf"), 1e300, None]
    df = one_column(spark, values, "double")
    cents = [110, -29, 435, 123456789, None, None, None, None]
    assert evaluated(df, amount_cents(F.col("v"))) == cents


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(), st.floats(-1e4, 1e4), st.integers(-(10**9), 10**9).map(lambda k: k / 1000), st.integers(-(10**12), 10**12).map(lambda k: float(np.nextafter(k / 1000 + 0.005, 0)))), min_size=300, max_size=300))
def test_cents_are_rounded_as_spark_rounds(spark, values):
    ties = [2.675, 1.005, 0.125, 0.135, -1.005, 8.345, 10.075, -0.001, -0.0, 0.005, -0.005, 1e9 + 0.005, 999999999.995, 1e11, None]
    df = one_column(spark, values + ties, "double")
    for ours, spark_s in zip(evaluated(df, round_cents(F.col("v"))), evaluated(df, F.round("v", 2)), strict=True):
        assert repr(ours) == repr(spark_s)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.floats(-1e19, 1e19), st.integers(-(10**12), 10**12).map(lambda c: c / 100)), min_size=50, max_size=50))
def test_parts_of_cents_add_up(spark, amounts):
    values = [*amounts, None, float("nan"), float("inf"), 1e18, -9.99e17, 42949672.95, -42949672.96]
    df = one_column(spark, values, "double")
    high, low = cent_parts(F.col("v"))
    expected = [int(np.rint(v * 100)) if v is not None and abs(v * 100) < 1e20 else None for v in values]
    assert [c is None for c in expected] == [c is None for c in evaluated(df, amount_cents(F.col("v")))]
    rows = df.select(high.alias("h"), low.alias("l")).collect()
    assert [None if r["l"] is None else r["h"] * 2**32 + r["l"] for r in rows] == expected
    assert all(abs(r["l"]) < 2**32 and r["h"] * r["l"] >= 0 for r in rows if r["l"] is not None)
    total = df.agg(sum_cents(high, low)).first()[0]
    assert int(total) == sum(c for c in expected if c is not None)
    assert df.limit(0).agg(sum_cents(high, low)).first()[0] is None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-(10**13), 10**13), min_size=50, max_size=50))
def test_cents_survive_the_way_through_doubles(spark, cents):
    df = one_column(spark, cents, "bigint")
    assert evaluated(df, amount_cents(cents_to_amount(F.col("v")))) == cents


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**6)), min_size=50, max_size=50
    )
)
def test_mean_is_rounded_half_up_exactly(spark, pairs):
    df = spark.createDataFrame(
        [(n, s, c) for n, (s, c) in enumerate(pairs)], "n int, s bigint, c bigint"
    )
    expected = [
        float((Decimal(s) / Decimal(c)).quantize(Decimal(1), ROUND_HALF_UP)) / 100
        for s, c in pairs
    ]
    assert evaluated(df, mean_amount(F.col("s"), F.col("c"))) == expected


def test_mean_of_ties_and_of_nothing(spark):
    df = spark.createDataFrame(
        [(1, 5, 2), (2, -5, 2), (3, 1, 3), (4, 0, 4), (5, None, 0)], "n int, s bigint, c bigint"
    )
    assert evaluated(df, mean_amount(F.col("s"), F.col("c"))) == [0.03, -0.03, 0.0, 0.0, None]


def test_mean_of_a_sum_near_the_bigint_limit(spark):
    df = spark.createDataFrame([(1, 2**63 - 1, 2)], "n int, s bigint, c bigint")
    assert evaluated(df, mean_amount(F.col("s"), F.col("c"))) == [float(2**62) / 100]
