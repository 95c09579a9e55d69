"""A layout of files by several columns at once, so that a filter on any of them leaves most files unread.

Each column's values are cut into ranges of about equal numbers of rows, and the bits of the ranges' numbers are interleaved: rows
near one another in all columns have near keys. Dealt by ranges of that key, a file spans few values of
each column, and Parquet's minima and maxima let a scan skip the rest.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, TimestampNTZType, TimestampType

SAMPLE = 20_000  # rows that the ranges are fitted on; every row is placed
_BITS = 6  # of a range's number


def range_bounds(df: DataFrame, columns: list[str], bits: int = _BITS, sample: int = SAMPLE) -> dict[str, list]:
    """For each column at most ``2 ** bits - 1`` increasing values between its ranges, from the rows with the least hashes.

    The sample bounds what reaches the driver and decides how even files are, not what they hold.
    """
    rows = df.select(*[F.col(f"`{c}`") for c in columns]).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), *[F.col(f"`{c}`") for c in columns]).limit(sample).collect()
    bounds = {}
    for k, name in enumerate(columns):
        values = sorted(r[k] for r in rows if r[k] is not None and r[k] == r[k])
        cuts = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        bounds[name] = sorted(set(cuts))
    return bounds


def cluster_key(bounds: dict[str, list], bits: int = _BITS) -> Column:
    """The interleaved bits of the ranges' numbers, the highest bit of each column first; NULL lies below all ranges."""

    def at_or_below(value: Column, cuts: list, first: int = 0) -> Column:
        """How many bounds are at or below the value, by bisection."""
        if not cuts:
            return F.lit(first)
        middle = len(cuts) // 2
        below, above = at_or_below(value, cuts[:middle], first), at_or_below(value, cuts[middle + 1 :], first + middle + 1)
        return F.when(value < F.lit(cuts[middle]), below).otherwise(above)

    def number(name: str, cuts: list) -> Column:
        """Of a value's range, spread over all bits."""
        value = F.col(f"`{name}`")
        step = (1 << bits) // (len(cuts) + 1)
        return F.when(value.isNull(), F.lit(0)).otherwise(at_or_below(value, cuts) * step).cast("bigint")

    numbers = [number(name, cuts) for name, cuts in bounds.items()]
    parts = []
    for bit in range(bits):
        for k, n in enumerate(numbers):
            one = F.shiftright(n, bit).bitwiseAND(F.lit(1).cast("bigint"))
            parts.append(F.shiftleft(one, bit * len(numbers) + len(numbers) - 1 - k))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def clustered(df: DataFrame, columns: list[str], files: int, bits: int = _BITS) -> DataFrame:
    """``df`` dealt to ``files`` partitions by ranges of the interleaved key, sorted by it; one range shuffle.

    Of ``n`` columns, a filter on one value range of one column then concerns about files ** (1 - 1 / n) files.
    """
    key = cluster_key(range_bounds(df, columns, bits), bits)
    # Equal keys are spread as well: a combination of ranges that holds a third of all rows is several files.
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.withColumns({"_key": key, "_spread": spread}).repartitionByRange(files, "_key", "_spread").sortWithinPartitions("_key").drop("_key", "_spread")


def dealt_evenly(df: DataFrame, files: int) -> DataFrame:
    """``df`` dealt to ``files`` partitions in no order, as many rows to each; by row numbers, for which no task sorts its rows."""
    return df.withColumn("_at", F.monotonically_increasing_id()).repartition(files, "_at").drop("_at")


def files_by_extent(table: DataFrame, columns: list[str]) -> DataFrame:
    """``file, rows`` of each file of a table that was just read, with each column's ``low_`` and ``high_``: what its footer says."""
    file = F.col("_metadata.file_path").alias("file")
    # Spark sorts all rows for extents of texts; of those, a file's distinct values are taken first.
    plain = [c for c in columns if isinstance(table.schema[c].dataType, (NumericType, DateType, TimestampType, TimestampNTZType, BooleanType))]

    def extents(names: list[str]) -> list[Column]:
        return [f(F.col(f"`{c}`")).alias(f"{p}_{c}") for c in names for p, f in (("low", F.min), ("high", F.max))]

    out = table.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), *extents(plain))
    for name in columns:
        if name not in plain:
            values = table.groupBy(file, F.col(f"`{name}`")).agg(F.count(F.lit(1)).alias("_times")).where("_times > 0")
            out = out.join(values.groupBy("file").agg(*extents([name])), "file")
    return out.select("file", "rows", *[f"`{p}_{c}`" for c in columns for p in ("low", "high")])
