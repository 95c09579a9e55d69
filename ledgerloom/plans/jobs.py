"""Batch jobs between the layers.

Every job recomputes its layer from the previous layer's files, so a rerun
gives the same tables. A job uses the caller's session and leaves its settings
alone. The counts it returns are exact also when tasks are retried: they are
observed in the stage that writes, where Spark counts every partition once.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.conform import clean_silver
from ledgerloom.operators.marts import mart_rollup, marts_from_rollup
from ledgerloom.operators.quality import dq_counts, split_quality
from ledgerloom.plans.paths import check_disjoint
from ledgerloom.schema import BRONZE_SCHEMA, SILVER_SCHEMA
from ledgerloom.sources.files import delete, exists
from ledgerloom.sources.parquet import (
    ROWS_PER_FILE,
    land_run,
    read_raw,
    read_table,
    write_parquet,
)
from ledgerloom.sources.quarantine import QUARANTINE_ROWS_PER_FILE, write_quarantine_csv
from ledgerloom.sources.scratch import scratch_path
from ledgerloom.sources.triage import read_accepted, rejected_files, triage_files


@dataclass(frozen=True)
class LayerPaths:
    """Where the layers lie; any file system that Spark can reach."""

    raw: str
    bronze: str
    silver: str
    quarantine: str
    gold: str

    @classmethod
    def under(cls, root: str) -> LayerPaths:
        root = root.rstrip("/")
        # Folder names.
        return cls(
            raw=f"{root}/raw",
            bronze=f"{root}/bronze/retail_sales_bronze",
            silver=f"{root}/silver/retail_sales_clean",
            quarantine=f"{root}/quarantine/bad_records",
            gold=f"{root}/gold",
        )


def _write_observed(df: DataFrame, path: str, *metrics: Column) -> dict[str, int]:
    """Writes and returns the metrics of the rows written, in one job.

    The observation sits on top of the plan and therefore in the writing stage.
    """
    written = Observation()
    write_parquet(df.observe(written, *metrics), path)
    return written.get


def _row_count(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def _is_stream_output(spark: SparkSession, path: str) -> bool:
    """Whether a streaming file sink keeps its log there."""
    return exists(spark, f"{path.rstrip('/')}/_spark_metadata")


def land(df: DataFrame, raw: str, run_id: str, *, rows_per_file: int = ROWS_PER_FILE) -> dict[str, int]:
    """Writes one run of raw files, see ``land_run``, and counts its rows while they are written."""
    landed = Observation()
    land_run(df.observe(landed, _row_count("landed_rows")), raw, run_id, rows_per_file=rows_per_file)
    return landed.get


def raw_to_bronze(
    spark: SparkSession, raw: str, bronze: str, *, recursive: bool = False, rejected: str | None = None
) -> dict[str, int]:
    """All landed runs, in the declared schema, as one table; no shuffle.

    A file that can't be read in it fails the job. With ``rejected``, a directory, such files are left out instead, and a
    table of them with the reasons is written there; see ``sources.triage``.
    """
    check_disjoint(spark, [raw], [bronze] if rejected is None else [bronze, rejected])
    if _is_stream_output(spark, bronze):
        raise ValueError(f"{bronze!r} is fed by a stream; overwriting it would break the stream")
    if rejected is None:
        return _write_observed(read_raw(spark, raw, recursive=recursive), bronze, _row_count("bronze_rows"))
    if recursive:
        raise ValueError("files are triaged by run, one directory below the landing zone")
    verdicts = triage_files(spark, raw)
    bad = rejected_files(spark, verdicts)
    write_parquet(bad, rejected)
    counts = _write_observed(read_accepted(spark, verdicts), bronze, _row_count("bronze_rows"))
    return counts | {"rejected_files": sum(v.kind == "rejected" for v in verdicts)}


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    quarantine: str,
    *,
    quarantine_rows_per_file: int = QUARANTINE_ROWS_PER_FILE,
) -> dict[str, int]:
    """Bad rows to the quarantine CSV, clean rows to silver; returns the counts.

    Bronze is read once for each. The report of all its rows is observed below
    the filter of the quarantine, which scans, filters and writes in one stage.
    """
    check_disjoint(spark, [bronze], [silver, quarantine])
    df = read_table(spark, bronze, BRONZE_SCHEMA)
    report = Observation()
    write_quarantine_csv(split_quality(df.observe(report, *dq_counts())).quarantine, quarantine, rows_per_file=quarantine_rows_per_file)
    return report.get | _write_observed(clean_silver(split_quality(df).valid), silver, _row_count("silver_rows"))


def silver_to_gold(spark: SparkSession, silver: str, gold: str) -> None:
    """The three marts, each to a directory of its name, from one scan of silver.

    The measures of all groups go to a table in the shared scratch folder, so
    that neither the second and third mart nor a lost executor costs another
    scan. It is deleted when the marts are written, or one of them fails.
    """
    rollup = scratch_path(spark, f"mart-rollup-{uuid.uuid4().hex}")
    check_disjoint(spark, [silver], [gold, rollup])
    try:
        write_parquet(mart_rollup(read_table(spark, silver, SILVER_SCHEMA)), rollup)
        for mart, df in marts_from_rollup(spark.read.parquet(rollup)).items():
            write_parquet(df, f"{gold.rstrip('/')}/{mart}")
    finally:
        delete(spark, rollup)


def run_pipeline(
    spark: SparkSession,
    paths: LayerPaths,
    *,
    incoming: DataFrame | None = None,
    run_id: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    quarantine_rows_per_file: int = QUARANTINE_ROWS_PER_FILE,
) -> dict[str, int]:
    """Lands ``incoming`` as run ``run_id`` if given, then bronze, silver, gold."""
    counts = {}
    if incoming is not None:
        if run_id is None:
            raise ValueError("incoming rows need a run_id")
        counts |= land(incoming, paths.raw, run_id, rows_per_file=rows_per_file)
    counts |= raw_to_bronze(spark, paths.raw, paths.bronze)
    counts |= bronze_to_silver(
        spark,
        paths.bronze,
        paths.silver,
        paths.quarantine,
        quarantine_rows_per_file=quarantine_rows_per_file,
    )
    silver_to_gold(spark, paths.silver, paths.gold)
    return counts
