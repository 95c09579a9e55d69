"""Gold as a state that batches add to: signed partial measures, merged when a mart is read.

The measures of a group are whole numbers (cents, counts, units), so that partials may come in any order, and a row
that is corrected is taken back exactly by a partial of opposite sign. Amounts without exact cents (NaN, infinite or
very large ones) can't be taken back from a sum of doubles; their values are part of the key, and how often each occurs is what is
added up. A group whose rows have all been taken back is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType, StructField, StructType

from ledgerloom.functions.money import sum_cents
from ledgerloom.operators.marts import MART_KEYS, mart_name, with_cents

_KEYS = [key for keys in MART_KEYS.values() for key in keys]
_COUNTS = ["amounts", "units", "known_units", "orders", "rows"]

MART_STATE_SCHEMA = StructType(
    [
        StructField("mart", StringType()),
        *[StructField(key, StringType()) for key in _KEYS],
        StructField("inexact", DoubleType()),
        StructField("cents", DecimalType(38, 0)),
        *[StructField(name, LongType()) for name in _COUNTS],
    ]
)


def mart_partials(silver: DataFrame) -> DataFrame:
    """Measures of the groups of all marts, in the shape of ``MART_STATE_SCHEMA``; one scan of eight columns."""
    sets = [[*[F.col(key) for key in keys], F.col("_inexact")] for keys in MART_KEYS.values()]
    grouped = with_cents(silver).groupingSets(sets, *[F.col(key) for key in _KEYS], F.col("_inexact"))
    return grouped.agg(
        mart_name().alias("mart"),
        F.coalesce(sum_cents(F.col("_high"), F.col("_low")), F.lit(0)).cast("decimal(38,0)").alias("cents"),
        F.count("total_amount").alias("amounts"),
        F.coalesce(F.sum("quantity"), F.lit(0).cast("bigint")).alias("units"),
        F.count("quantity").alias("known_units"),
        F.count("transaction_id").alias("orders"),
        F.count(F.lit(1)).alias("rows"),
    ).select("mart", *_KEYS, F.col("_inexact").alias("inexact"), "cents", *_COUNTS)


def merge_partials(partials: DataFrame) -> DataFrame:
    """One row for each group and inexact value of any number of partials; those that cancel out go."""
    merged = partials.groupBy("mart", *_KEYS, "inexact").agg(*[F.sum(name).alias(name) for name in ("cents", *_COUNTS)])
    left = F.lit(False)
    for name in ("cents", *_COUNTS):
        left |= F.col(name) != 0
    return merged.where(left).select(*[F.col(f.name).cast(f.dataType) for f in MART_STATE_SCHEMA.fields])


def change_partials(before: DataFrame, after: DataFrame) -> DataFrame:
    """What turns the state of ``before`` into that of ``after`` (both silver rows): the new partials, less the old ones."""
    old = mart_partials(before)
    taken_back = old.select("mart", *_KEYS, "inexact", *[(-F.col(name)).alias(name) for name in ("cents", *_COUNTS)])
    return merge_partials(mart_partials(after).unionByName(taken_back))


def rollup_from_state(partials: DataFrame) -> DataFrame:
    """The state in the columns of ``mart_rollup``, from which ``marts_from_rollup`` cuts the marts."""
    counted = F.col("amounts")
    return (
        merge_partials(partials)
        .groupBy(*_KEYS, "mart")
        .agg(
            F.sum(F.when(F.col("inexact").isNull() & (counted != 0), F.col("cents"))).alias("cents"),
            F.sum(F.when(F.col("inexact").isNotNull(), F.col("inexact") * counted)).alias("inexact"),
            F.sum(counted).alias("amounts"),
            F.when(F.sum("known_units") != 0, F.sum("units")).alias("units"),
            F.sum("orders").alias("orders"),
            F.sum("rows").alias("_rows"),
        )
        .where("_rows <> 0")
        .drop("_rows")
    )
