"""Standardisation and de-duplication of valid transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.conform import gender_code

KEY = "transaction_id"


def standardize_gender(df: DataFrame) -> DataFrame:
    """Rewrites ``gender`` in place to ``M``, ``F`` or ``Unknown``."""
    return df.withColumn("gender", gender_code(F.col("gender")))


def dedup_transactions(df: DataFrame) -> DataFrame:
    """One row per ``transaction_id``: the smallest in column order, NULLs first.

    All NULL ids together are one transaction. The choice depends on the values
    alone, never on the partitioning. ``row_number() == 1`` lets Spark keep a
    single row per id already before the shuffle, so an id that holds a large
    share of all rows reaches its reducer as one row per map task.
    """
    others = [F.col(name).asc_nulls_first() for name in df.columns if name != KEY]
    # Ordering by the key itself covers a frame that has no other column.
    smallest_first = Window.partitionBy(KEY).orderBy(*(others or [F.col(KEY)]))
    position = "_position"
    return (
        df.withColumn(position, F.row_number().over(smallest_first))
        .filter(F.col(position) == 1)
        .drop(position)
    )


def clean_silver(valid: DataFrame) -> DataFrame:
    """Silver from the valid rows: standardised, then one row per transaction."""
    return dedup_transactions(standardize_gender(valid))
