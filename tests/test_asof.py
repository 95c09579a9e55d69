from __future__ import annotations

import random

import pytest
from conftest import plan_text, sorted_rows
from pyspark.sql import functions as F

from ledgerloom.operators import asof, asof_join

LEFT = "row int, k string, g int, at timestamp"
RIGHT = "k string, g int, since timestamp, price double, note string"


def joined(spark, left, right, **options):
    left, right = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    at, since = (F.col(c).cast("timestamp") for c in ("at", "since"))
    return asof_join(left.withColumn("at", at), right.withColumn("since", since), keys=["k", "g"], left_time="at", right_time="since", values=["price", "note"], **options)


def brute(left, right):
    out = []
    for row, k, g, at in left:
        fits = [(since, price is not None, price or 0.0, note is not None, note or "") for k2, g2, since, price, note in right if k2 == k and g2 == g and None not in (k, g, at, since) and since <= at]
        best = max(fits) if fits else None
        out.append((row, k, g, at, best[2] if best and best[1] else None, best[4] if best and best[3] else None))
    return sorted(out, key=repr)


def made_up(seed, n, days):
    import datetime

    rnd = random.Random(seed)

    def time():
        return rnd.choice([None] + [datetime.datetime(2024, 1, 1) + datetime.timedelta(days=rnd.randrange(days), hours=rnd.choice([0, 12])) for _ in range(20)])

    left = [(i, rnd.choice(["a", "b", "c", None]), rnd.choice([1, 2, None]), time()) for i in range(n)]
    right = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), time(), rnd.choice([None, 1.0, 2.5, 7.0]), rnd.choice([None, "x", "y"])) for _ in range(n // 4)]
    return left + left[:5], right + right[:3]


@pytest.mark.parametrize("days", [3, 200, 2000])
def test_against_comparing_all_times(spark, days):
    left, right = made_up(days, 200, days)
    for time_bin in ({}, {"time_bin": lambda t: F.unix_date(t.cast("date"))}, {"time_bin": lambda t: F.lit(0)}):
        assert sorted_rows(joined(spark, left, right, **time_bin)) == brute(left, right)


def test_empty_sides(spark):
    left, right = made_up(1, 20, 50)
    assert sorted_rows(joined(spark, left, [])) == brute(left, [])
    assert joined(spark, [], right).collect() == []


def test_columns_keep_their_order_and_may_not_clash(spark):
    left, right = made_up(1, 20, 50)
    assert joined(spark, left, right).columns == ["row", "k", "g", "at", "price", "note"]
    df = spark.createDataFrame(left, LEFT)
    with pytest.raises(ValueError, match="both sides"):
        asof_join(df, df, keys=["k"], left_time="at", right_time="at", values=["row"])
    with pytest.raises(ValueError, match="different types"):
        asof_join(df, df.select("k", F.col("at").cast("date").alias("day"), F.col("row").alias("v")), keys=["k"], left_time="at", right_time="day", values=["v"])


def test_a_hot_key_is_dealt_by_bin(spark):
    """All rows have one key: no task gets more than its bins, and no row is compared with every other."""
    base = spark.range(0, 24_000, 1, 8)
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 720).cast("int"))
    left = base.select(F.lit("hot").alias("k"), day.alias("at"), "id")
    right = base.where("id % 3 = 0").select(F.lit("hot").alias("k"), day.alias("since"), F.col("id").alias("price"))
    df = asof_join(left, right, keys=["k"], left_time="at", right_time="since", values=["price"])
    plan = plan_text(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 24_000 and max(sizes) < 24_000 / 3


def test_only_large_keys_are_binned(spark, monkeypatch):
    left, right = made_up(5, 200, 2000)
    unused = {"time_bin": lambda t: F.raise_error(F.lit("binned")).cast("int")}
    assert sorted_rows(joined(spark, left, right, **unused)) == brute(left, right)
    # Some keys below, some above.
    monkeypatch.setattr(asof, "BINNED", 30)
    hot = [(1000 + i, "a", 1, at) for i, (_, _, _, at) in enumerate(left)]
    assert sorted_rows(joined(spark, left + hot, right)) == brute(left + hot, right)
