"""Bronze that reads each landed file once instead of all files every time."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.paths import check_disjoint
from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources.parquet import raw_glob


def ingest_new_runs(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    *,
    max_files_per_trigger: int = 10_000,
    max_file_age: str = "36500d",
) -> StreamingQuery:
    """Appends the files that landed since the last call and returns when done.

    The checkpoint remembers the files seen and the sink's log the files
    written: after a crash nothing is lost or doubled, and readers of
    ``bronze`` see finished batches only. A projection without state; rows are
    neither reordered nor compared.

    A batch takes at most ``max_files_per_trigger`` files, so that a backlog is
    not repeated whole when it fails. ``max_file_age`` is the horizon for late
    files, counted back from the newest one seen: Spark's usual week would
    silently skip a run that is copied in with older file times. The price of a
    long one is that the driver keeps the names of all landed files. The sink's
    log has no retention, since readers of ``bronze`` no longer see files that
    it drops; it grows with the bronze files. ``latestFirst`` stays off.
    """
    check_disjoint(spark, [raw], [bronze, checkpoint])
    stream = spark.readStream.schema(RAW_SCHEMA).options(
        maxFileAge=max_file_age, maxFilesPerTrigger=max_files_per_trigger
    )
    query = (
        stream.parquet(raw_glob(raw))
        .writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
