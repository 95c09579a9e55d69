"""Parquet scans with an explicit schema, and Parquet writes.

The declared schema is what makes files of different ages readable together: a
column that a file lacks is NULL, one that the schema lacks is dropped, 32-bit
integers widen to ``bigint``. Anything else (a string where a number belongs)
fails the job. No footer is read to infer a schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources.files import exists


# Upper bound for a landed file: 16 columns of five million rows take roughly 128 MB.
ROWS_PER_FILE = 5_000_000


def raw_glob(raw_root: str) -> str:
    """All run directories of the landing zone."""
    return raw_root.rstrip("/") + "/*"


def read_raw(spark: SparkSession, raw_root: str, *, recursive: bool = False) -> DataFrame:
    """Every landed run as one frame.

    Files lie directly in ``raw_root/<run>/``. Deeper ones are read only with
    ``recursive``. A landing zone without any run is an error.
    """
    reader = spark.read.schema(RAW_SCHEMA)
    if recursive:
        return reader.option("recursiveFileLookup", "true").parquet(raw_root)
    return reader.parquet(raw_glob(raw_root))


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One layer's table; an empty directory is an empty table."""
    return spark.read.schema(schema).parquet(path)


def write_parquet(df: DataFrame, path: str) -> None:
    """Replaces the table at ``path``; one file per task, no shuffle of its own."""
    df.write.mode("overwrite").parquet(path)


def land_run(df: DataFrame, raw_root: str, run_id: str, *, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Writes one run of raw files and returns its directory.

    Files hold at most ``rows_per_file`` rows and no row is left out. A run id
    is landed once: repeating it fails instead of adding the rows again. A
    directory without ``_SUCCESS`` is a landing that failed, and is replaced.
    """
    run_dir = f"{raw_root.rstrip('/')}/{run_id}"
    mode = "errorifexists" if exists(df.sparkSession, f"{run_dir}/_SUCCESS") else "overwrite"
    df.write.option("maxRecordsPerFile", rows_per_file).mode(mode).parquet(run_dir)
    return run_dir
