"""Quarantine CSV: written so that the rejected values can be read back unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schema import QUARANTINE_SCHEMA

# Without these Spark trims the values it writes, and the evidence is lost.
_KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Stands for "no value" while parsing, so that an empty field (NULL) differs
# from a quoted empty string.
_NO_VALUE = "\u0000"

QUARANTINE_ROWS_PER_FILE = 1_000_000


def write_quarantine_csv(df: DataFrame, path: str, *, rows_per_file: int = QUARANTINE_ROWS_PER_FILE) -> None:
    """Replaces the CSV files (with header) at ``path``; no file has more than ``rows_per_file`` rows.

    Every task writes its own rows, in the stage that scans and filters them:
    nothing is moved, whatever the size, and an observation on ``df`` is exact.
    Tasks without rows write no file, but for the first, whose file is a header.

    A value of exactly U+0000 is read back as NULL; all others are kept.
    """
    options = {"header": "true", "maxRecordsPerFile": str(rows_per_file), **_KEEP_SPACES}
    df.write.options(**options).mode("overwrite").csv(path)


def read_quarantine_csv(spark: SparkSession, *paths: str) -> DataFrame:
    """The quarantined rows of all ``paths`` with their types; line breaks in values are kept.

    A file is one task, hence ``write_quarantine_csv`` limits what a file holds.
    """
    return (
        spark.read.schema(QUARANTINE_SCHEMA)
        .options(header="true", multiLine="true", nullValue=_NO_VALUE, **_KEEP_SPACES)
        .csv(list(paths))
    )
