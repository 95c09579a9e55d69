"""Silver, quarantine and gold kept current batch by batch, at the cost of what a batch touches.

Silver lies in buckets by a hash of ``transaction_id``. A batch is standardised and de-duplicated, and only the buckets that
its ids fall into are read, merged and written anew; the others keep their files. The rule of ``dedup_transactions``, the
smallest row of an id, holds for any grouping and order of the rows, so that batches in any order, and repeated ones,
end with what a full rebuild gives.

Gold gets signed partials of the touched buckets, new less old, and quarantine the batch's bad rows. All of it becomes
visible by one commit (``sources.versions``), which also records the batch's id: a batch that breaks off anywhere has changed nothing, and
one that is delivered again does nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.conform import KEY, clean_silver, dedup_transactions, standardize_gender
from ledgerloom.operators.mart_state import MART_STATE_SCHEMA, change_partials, merge_partials, rollup_from_state
from ledgerloom.operators.marts import marts_from_rollup
from ledgerloom.operators.quality import dq_counts, dq_report, split_quality
from ledgerloom.plans.paths import check_disjoint
from ledgerloom.schema import QUARANTINE_SCHEMA, RAW_SCHEMA, SILVER_SCHEMA
from ledgerloom.sources.files import children
from ledgerloom.sources.parquet import raw_glob, write_parquet
from ledgerloom.sources.quarantine import QUARANTINE_ROWS_PER_FILE, read_quarantine_csv, write_quarantine_csv
from ledgerloom.sources.versions import Commit, Lake, Manifest

SILVER, QUARANTINE, GOLD = "silver", "quarantine", "gold_state"
BUCKETS = 256  # of a new silver table; about a gigabyte each is a good size
_BUCKET = "_bucket"
_MERGE_AFTER = 64  # partials of gold that are kept apart


def key_bucket(buckets: int) -> Column:
    """The bucket of a row. It is also the shuffle partition of its id where there are as many partitions, so that a
    bucket then is one file."""
    return F.pmod(F.hash(KEY), F.lit(buckets))


def _write_buckets(df: DataFrame, directory: str, buckets: int) -> dict[str, str]:
    """Writes rows by bucket and returns the directory of each bucket that got some."""
    df.withColumn(_BUCKET, key_bucket(buckets)).write.partitionBy(_BUCKET).parquet(directory)
    found = [name for name in children(df.sparkSession, directory) if name.startswith(f"{_BUCKET}=")]
    return {f"{int(name.partition('=')[2]):06d}": f"{directory}/{name}" for name in found}


def upsert_silver(commit: Commit, rows: DataFrame, buckets: int) -> list[str]:
    """Adds to ``commit`` the buckets of silver that change with ``rows``, which are standardised, and returns their names.

    The ids alone tell which stored buckets the batch falls into. Their rows and the batch's are de-duplicated and written once, together with
    the buckets that are new.
    """
    stored = commit.base.parts.get(SILVER, {})
    both = []
    if stored:
        found = rows.select(key_bucket(buckets).alias(_BUCKET)).distinct().collect()
        both = sorted({f"{r[_BUCKET]:06d}" for r in found} & stored.keys())
    if both:
        rows = commit.lake.read(SILVER, SILVER_SCHEMA, manifest=commit.base, parts=both).unionByName(rows)
    written = _write_buckets(dedup_transactions(rows), commit.directory(SILVER), buckets)
    if sorted(written.keys() & stored.keys()) != both:
        raise RuntimeError("the batch changed while it was read")
    for part, directory in written.items():
        commit.put(SILVER, part, directory)
    return sorted(written)


def apply_batch(
    lake: Lake,
    batch: DataFrame,
    batch_id: str,
    *,
    buckets: int = BUCKETS,
    quarantine_rows_per_file: int = QUARANTINE_ROWS_PER_FILE,
    before_publish: Callable[[Commit], None] | None = None,
) -> dict[str, int]:
    """Brings silver, quarantine and gold up to date with a batch of raw rows, in one commit; returns counts.

    A batch id is applied once: later calls with it return no counts and change nothing. ``buckets`` counts when the first batch
    makes the table. ``before_publish`` may add outputs of its own to the commit. Batches are applied
    one at a time; of two at once the later to publish fails with ``CommitConflict`` and can be repeated.
    """
    commit = lake.commit()
    if batch_id in commit.base.applied:
        return {}
    spark = batch.sparkSession
    buckets = commit.base.settings.get("buckets", buckets)
    parts = split_quality(batch)
    report = Observation()
    bad = commit.directory(QUARANTINE)
    write_quarantine_csv(split_quality(batch.observe(report, *dq_counts())).quarantine, bad, rows_per_file=quarantine_rows_per_file)
    counts = report.get
    if counts["quarantine_rows"]:
        commit.put(QUARANTINE, batch_id, bad)
    touched = upsert_silver(commit, standardize_gender(parts.valid), buckets)
    if touched:
        after = [f"{lake.root}/{commit.parts(SILVER)[part]}" for part in touched]
        change = change_partials(lake.read(SILVER, SILVER_SCHEMA, manifest=commit.base, parts=touched), spark.read.schema(SILVER_SCHEMA).parquet(*after))
        _add_partials(commit, change, batch_id)
    if before_publish:
        before_publish(commit)
    commit.publish(batch_id=batch_id, settings={"buckets": buckets})
    return counts | {"rewritten_buckets": len(touched)}


def _add_partials(commit: Commit, change: DataFrame, batch_id: str) -> None:
    """One more part of gold; when there are many, all of them as one."""
    held = commit.base.parts.get(GOLD, {})
    directory = commit.directory(GOLD)
    if len(held) < _MERGE_AFTER:
        write_parquet(change, directory)
    else:
        stored = commit.lake.read(GOLD, MART_STATE_SCHEMA, manifest=commit.base)
        write_parquet(merge_partials(stored.unionByName(change)), directory)
        commit.remove(GOLD, list(held))
    commit.put(GOLD, batch_id, directory)


def current_silver(lake: Lake, manifest: Manifest | None = None) -> DataFrame:
    return lake.read(SILVER, SILVER_SCHEMA, manifest=manifest)


def current_quarantine(lake: Lake, manifest: Manifest | None = None) -> DataFrame:
    found = lake.directories(QUARANTINE, manifest)
    return read_quarantine_csv(lake.spark, *found) if found else lake.spark.createDataFrame([], QUARANTINE_SCHEMA)


def current_rollup(lake: Lake, manifest: Manifest | None = None) -> DataFrame:
    """The measures of all marts, merged from the partials of all batches; silver isn't read."""
    return rollup_from_state(lake.read(GOLD, MART_STATE_SCHEMA, manifest=manifest))


def current_marts(lake: Lake, manifest: Manifest | None = None) -> dict[str, DataFrame]:
    """Mart name -> mart."""
    return marts_from_rollup(current_rollup(lake, manifest))


def follow_runs(
    spark: SparkSession,
    raw: str,
    lake: Lake,
    checkpoint: str,
    *,
    stream: str = "runs",
    buckets: int = BUCKETS,
    max_files_per_trigger: int = 10_000,
    max_file_age: str = "36500d",
) -> StreamingQuery:
    """Applies the files that landed since the last call, in batches, and returns when done.

    The stream may deliver a batch again after a crash, under the same number; the manifest knows it then. ``stream`` tells apart
    several streams that feed one lake, and a stream that starts anew with another checkpoint.
    """
    check_disjoint(spark, [raw], [lake.root, checkpoint])

    def apply(batch: DataFrame, number: int) -> None:
        apply_batch(Lake(batch.sparkSession, lake.root), batch, f"{stream}-{number:09d}", buckets=buckets)

    files = spark.readStream.schema(RAW_SCHEMA).options(maxFileAge=max_file_age, maxFilesPerTrigger=max_files_per_trigger).parquet(raw_glob(raw))
    query = files.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _at_once(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """The results of jobs that run side by side. All have ended when this returns, or raises what the first failed one raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in running]


def rebuild(lake: Lake, raw: DataFrame, *, buckets: int = BUCKETS, before_publish: Callable[[Commit], None] | None = None) -> dict[str, int]:
    """Replaces silver, quarantine and gold by what all of ``raw`` gives, in one commit; returns counts.

    The whole-table job of ``bronze_to_silver`` and ``silver_to_gold`` without a time at which
    new silver lies beside old quarantine or old marts. Batches applied before stay known by their ids.
    """
    commit = lake.commit()
    for table in (SILVER, QUARANTINE, GOLD):
        commit.remove(table, list(commit.base.parts.get(table, {})))
    buckets = commit.base.settings.get("buckets", buckets)
    parts = split_quality(raw)
    bad, state = commit.directory(QUARANTINE), commit.directory(GOLD)

    def silver_and_gold() -> dict[str, str]:
        written = _write_buckets(clean_silver(parts.valid), commit.directory(SILVER), buckets)
        silver = raw.sparkSession.read.schema(SILVER_SCHEMA).parquet(*written.values()) if written else raw.sparkSession.createDataFrame([], SILVER_SCHEMA)
        write_parquet(change_partials(silver.limit(0), silver), state)
        return written

    # Neither output needs the other, so that the tasks of one fill the cores that the last ones of the other leave. The counts read three columns;
    # observed on the rows of the quarantine's scan they would have all columns of all rows decoded, where it now decodes the bad ones.
    written, _, counts = _at_once(
        raw.sparkSession, silver_and_gold, lambda: write_quarantine_csv(parts.quarantine, bad), lambda: dq_report(raw).first().asDict()
    )
    commit.put(QUARANTINE, "rebuilt", bad)
    for part, directory in written.items():
        commit.put(SILVER, part, directory)
    commit.put(GOLD, "rebuilt", state)
    if before_publish:
        before_publish(commit)
    commit.publish(settings={"buckets": buckets})
    return counts
