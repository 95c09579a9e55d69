"""As-of join: to each row of one table the row of another that is valid at its time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BINNED = 10_000  # rows of a key, both sides together, from which on it is dealt by time bin


def by_month(time: Column) -> Column:
    return F.date_trunc("month", time.cast("timestamp"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: list[str],
    left_time: str,
    right_time: str,
    values: list[str],
    time_bin: Callable[[Column], Column] = by_month,
) -> DataFrame:
    """Every row of ``left`` with ``values`` of the latest row of ``right`` with the same ``keys`` whose ``right_time`` is at or
    before ``left_time``; NULL values where there is none, or where a key or ``left_time`` is NULL.

    Of several such rows with one time the greatest in the order of ``values`` counts. The times are of one type.

    No time is compared with all others of its key: rows of both sides are sorted together by (key, time) and the latest value
    is carried forward. Keys of ``BINNED`` rows and more are sorted within key and time bin, so that a key which holds a third of all rows is
    as many groups as it has bins; what is valid when a bin begins comes from one row for each key and bin. ``time_bin`` gives the
    bin of a time; it must not decrease with the time, and finer bins make smaller groups. The other keys are a group each. Keys
    are counted first; of ``n`` rows at most n / ``BINNED`` keys are sent to all tasks.
    """
    taken = {*left.columns} & {*values}
    if taken:
        raise ValueError(f"both sides have columns {sorted(taken)}")
    types = {side.schema[name].dataType for side, name in ((left, left_time), (right, right_time))}
    if len(types) > 1:
        raise ValueError(f"times of different types: {left_time!r} and {right_time!r}")

    named = [F.col(f"`{key}`").alias(f"_k{n}") for n, key in enumerate(keys)]
    group = [f"_k{n}" for n in range(len(keys))]
    known = left.select(*named, F.col(f"`{left_time}`").alias("_time"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
    complete = F.col("_time").isNotNull()
    for key in group:
        complete &= F.col(key).isNotNull()
    state = F.struct(*[F.col(f"`{v}`") for v in values])
    changes = right.select(*named, F.col(f"`{right_time}`").alias("_time"), state.alias("_state")).where(complete)
    asked = known.where(complete)
    large = asked.select(*group).unionAll(changes.select(*group)).groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= BINNED)
    # Halves by time keep it a join by keys where the given ones are constants, which Spark takes out of the condition.
    large = F.broadcast(large.select(*group, F.explode(F.array(F.lit(0), F.lit(1))).alias("_half"), F.lit(True).alias("_large")))
    asked, changes = (df.withColumn("_half", F.pmod(F.hash("_time"), F.lit(2))).join(large, [*group, "_half"], "left") for df in (asked, changes))
    # Keys that aren't large have no bin.
    asked, changes = (df.withColumn("_bin", F.when(F.col("_large"), time_bin(F.col("_time")))) for df in (asked, changes))
    single = changes.where("_large is null").select(*group, "_bin", "_time", "_state")
    changes = changes.where("_large").groupBy(*group, "_bin", "_time").agg(F.max("_state").alias("_state"))

    last = changes.groupBy(*group, "_bin").agg(F.max_by("_state", "_time").alias("_state"))
    bins = last.unionByName(asked.where("_large").select(*group, "_bin").distinct().withColumn("_state", F.lit(None).cast(last.schema["_state"].dataType)))
    bins = bins.groupBy(*group, "_bin").agg(F.max("_state").alias("_state"))  # one row has a state at most
    before = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = bins.select(*group, "_bin", F.last("_state", ignorenulls=True).over(before).alias("_state")).where("_state is not null")

    no_row, no_state = (F.lit(None).cast(df.schema[c].dataType) for df, c in ((known, "_row"), (changes, "_state")))
    no_time = F.lit(None).cast(known.schema["_time"].dataType)
    columns = [*group, "_bin", "_time", "_kind", "_state", "_row"]
    together = (
        carried.withColumns({"_time": no_time, "_kind": F.lit(0), "_row": no_row}).select(*columns)
        .unionAll(changes.unionByName(single).withColumns({"_kind": F.lit(1), "_row": no_row}).select(*columns))
        .unionAll(asked.withColumns({"_kind": F.lit(2), "_state": no_state}).select(*columns))
    )
    so_far = Window.partitionBy(*group, "_bin").orderBy(F.asc_nulls_first("_time"), "_kind", "_state").rowsBetween(Window.unboundedPreceding, 0)
    found = together.withColumn("_state", F.last("_state", ignorenulls=True).over(so_far)).where("_kind = 2").select("_row", "_state")
    found = found.unionAll(known.where(~complete).select("_row", no_state.alias("_state")))
    return found.select("_row.*", "_state.*")
