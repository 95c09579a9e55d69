"""Counts and sums by event time, kept current as files land, with rows that come too late told apart.

Spark's state store holds the open windows and a watermark closes them. Each batch's changed windows become one part of
a versioned table, under the batch's number, so that a batch that is delivered again changes nothing. A second, stateless
stream tallies what landed: input less what the windows hold is what came after its window was closed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerloom.plans.paths import check_disjoint
from ledgerloom.sources.parquet import raw_glob, write_parquet
from ledgerloom.sources.versions import Lake

WINDOWS, TALLY = "windows", "tally"
TALLY_SCHEMA = "rows bigint, timed bigint"
_MERGE_AFTER = 64  # parts that are kept apart


class EventWindows:
    """Windows of ``width`` over events that land as Parquet files in ``raw/<run>/``.

    ``keys`` and ``time`` are columns of ``schema``; ``sums`` maps names to expressions whose sums over whole numbers or
    decimals are kept beside the row count ``rows``. A row is late when its window ended ``delay`` or more before the latest time seen
    by earlier calls of :meth:`follow` (and, in a call of several batches, by those before the last one: Spark applies a watermark
    one batch after it was found); it is dropped and counted.
    Rows without a time belong to no window and are counted apart. A NULL key is a key.
    """

    def __init__(self, lake: Lake, raw: str, checkpoint: str, *, schema: StructType, time: str, keys: list[str], sums: dict[str, Column], width: str, delay: str):
        check_disjoint(lake.spark, [raw], [lake.root, checkpoint])
        self.lake, self.raw, self.checkpoint = lake, raw, checkpoint
        self.schema, self.time, self.keys, self.sums, self.width, self.delay = schema, time, keys, sums, width, delay

    def _files(self, spark: SparkSession, max_files: int) -> DataFrame:
        options = {"maxFileAge": "36500d", "maxFilesPerTrigger": max_files}
        return spark.readStream.schema(self.schema).options(**options).parquet(raw_glob(self.raw))

    def changes(self, events: DataFrame) -> DataFrame:
        """``window_start``, keys, ``rows`` and sums by window; of a stream, the windows that a batch changes."""
        window = F.window(self.time, self.width).alias("_window")
        grouped = events.withWatermark(self.time, self.delay).groupBy(window, *self.keys)
        totals = grouped.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(value).alias(name) for name, value in self.sums.items()])
        return totals.select(F.col("_window.start").alias("window_start"), *self.keys, "rows", *self.sums)

    def _stored(self) -> StructType:
        plain = self.changes(self.lake.spark.createDataFrame([], self.schema)).schema
        return StructType([*[StructField(f.name, f.dataType) for f in plain.fields], StructField("batch", LongType())])

    def follow(self, spark: SparkSession, *, max_files_per_trigger: int = 10_000) -> None:
        """Takes in the files that landed since the last call and returns when done."""
        self._run(self._files(spark, max_files_per_trigger), TALLY, "append", self._tally)
        self._run(self.changes(self._files(spark, max_files_per_trigger)), WINDOWS, "update", self._update)

    def _run(self, stream: DataFrame, table: str, mode: str, apply: Callable[[Lake, DataFrame, int], None]) -> None:
        def once(batch: DataFrame, number: int) -> None:
            lake = Lake(batch.sparkSession, self.lake.root)
            if f"{table}-{number:09d}" not in lake.current().applied:
                apply(lake, batch, number)
            else:  # the state store still needs the batch computed
                batch.write.format("noop").mode("append").save()

        writer = stream.writeStream.outputMode(mode).foreachBatch(once).option("checkpointLocation", f"{self.checkpoint}/{table}")
        writer.trigger(availableNow=True).start().awaitTermination()

    def _tally(self, lake: Lake, batch: DataFrame, number: int) -> None:
        self._publish(lake, TALLY, batch.agg(F.count(F.lit(1)).alias("rows"), F.count(self.time).alias("timed")), number, TALLY_SCHEMA, lambda held: held.agg(F.sum("rows").alias("rows"), F.sum("timed").alias("timed")))

    def _update(self, lake: Lake, batch: DataFrame, number: int) -> None:
        self._publish(lake, WINDOWS, batch.withColumn("batch", F.lit(number).cast("bigint")), number, self._stored(), self._latest)

    def _publish(self, lake: Lake, table: str, rows: DataFrame, number: int, schema, merged: Callable[[DataFrame], DataFrame]) -> None:
        """The batch's rows as one part more; many parts become one."""
        commit = lake.commit()
        held = commit.base.parts.get(table, {})
        directory = commit.directory(table)
        if len(held) >= _MERGE_AFTER:
            rows = merged(lake.read(table, schema, manifest=commit.base).unionByName(rows))
            commit.remove(table, list(held))
        write_parquet(rows, directory)
        commit.put(table, f"{number:09d}", directory)
        commit.publish(batch_id=f"{table}-{number:09d}")

    def _latest(self, parts: DataFrame) -> DataFrame:
        """Each window as the last batch that changed it left it."""
        state = F.struct("batch", "rows", *self.sums)
        last = parts.groupBy("window_start", *self.keys).agg(F.max_by(state, "batch").alias("_state"))
        return last.select("window_start", *self.keys, "_state.rows", *[F.col(f"_state.{name}") for name in self.sums], "_state.batch")

    def current(self) -> DataFrame:
        """``window_start``, keys, ``rows`` and sums of all windows, open ones included."""
        return self._latest(self.lake.read(WINDOWS, self._stored())).drop("batch")

    def report(self) -> DataFrame:
        """One row: ``input_rows = window_rows + late_rows + untimed_rows``."""
        tally = self.lake.read(TALLY, TALLY_SCHEMA).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("input_rows"), F.coalesce(F.sum("timed"), F.lit(0)).alias("timed"))
        kept = self.current().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("window_rows"))
        # Two tables of one row.
        both = tally.join(F.broadcast(kept))
        return both.select("input_rows", "window_rows", (F.col("timed") - F.col("window_rows")).alias("late_rows"), (F.col("input_rows") - F.col("timed")).alias("untimed_rows"))
