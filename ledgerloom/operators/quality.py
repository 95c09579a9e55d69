"""Quality split of bronze and the counts that account for every row."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.rules import is_bad_record, quality_rules


class QualitySplit(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame


def split_quality(df: DataFrame) -> QualitySplit:
    """Rows for which no rule holds, and rows for which some rule holds.

    Rows that the rules cannot decide (NULL) are in neither part; ``dq_counts``
    reports them. The conditions stay bare comparisons of columns, so both
    parts push them down to the Parquet scan.
    """
    bad = is_bad_record()
    return QualitySplit(valid=df.filter(~bad), quarantine=df.filter(bad))


def dq_counts() -> list[Column]:
    """Aggregates of one pass over bronze, for ``agg`` or ``observe``.

    valid + quarantine + indeterminate = raw; a row may break several rules.
    """
    bad = is_bad_record()
    return [
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~bad).alias("valid_rows"),
        F.count_if(bad).alias("quarantine_rows"),
        F.count_if(bad.isNull()).alias("indeterminate_rows"),
        *[F.count_if(rule).alias(name) for name, rule in quality_rules().items()],
    ]


def dq_report(df: DataFrame) -> DataFrame:
    """One row of ``dq_counts``; reads only the three tested columns."""
    return df.agg(*dq_counts())
