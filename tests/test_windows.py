from __future__ import annotations

import pytest
from conftest import sorted_rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ledgerloom.sources import Lake, land_run
from ledgerloom.streaming import EventWindows, windows

SCHEMA = StructType([StructField("at", TimestampType()), StructField("kind", StringType()), StructField("amount", LongType())])


@pytest.fixture
def place(spark, tmp_path):
    """Lands runs and makes the windows anew for every call, as another process would."""

    class Place:
        raw = str(tmp_path / "raw")
        lake = Lake(spark, str(tmp_path / "lake"))
        runs = 0

        def windows(self):
            return EventWindows(self.lake, self.raw, str(tmp_path / "checkpoint"), schema=SCHEMA, time="at", keys=["kind"], sums={"amount": F.col("amount")}, width="1 day", delay="2 days")

        def land(self, *rows):
            df = spark.createDataFrame([(d and f"2024-01-{d}", k, a) for d, k, a in rows], "at string, kind string, amount bigint")
            land_run(df.withColumn("at", F.col("at").cast("timestamp")), self.raw, f"run_{self.runs:03d}")
            self.runs += 1

        def follow(self, **options):
            self.windows().follow(spark, **options)

        def found(self):
            return sorted_rows(self.windows().current().withColumn("window_start", F.dayofmonth("window_start")))

        def report(self):
            return tuple(self.windows().report().first())

    return Place()


def test_batches_equal_the_whole_where_nothing_is_late(spark, place):
    place.land(("01 10:00:00", "a", 1), ("02 11:00:00", "a", 2))
    place.follow()
    place.land(("01 12:00:00", "a", 4), ("02 00:00:00", None, 8), ("03 00:00:00", "b", None))
    place.follow()
    place.follow()
    assert place.found() == sorted([(1, "a", 2, 5), (2, "a", 1, 2), (2, None, 1, 8), (3, "b", 1, None)], key=repr)
    assert place.report() == (5, 5, 0, 0)
    whole = place.windows().changes(spark.read.schema(SCHEMA).parquet(f"{place.raw}/*"))
    assert sorted_rows(whole.withColumn("window_start", F.dayofmonth("window_start"))) == place.found()


def test_late_rows_are_dropped_and_counted(place):
    place.land(("01 10:00:00", "a", 1), ("10 12:00:00", "a", 1))
    place.follow()
    # Windows that ended on the 8th at noon or before are closed.
    place.land(("01 11:00:00", "a", 1), ("07 23:00:00", "a", 1), ("08 13:00:00", "a", 1), (None, "a", 1))
    place.follow()
    assert place.found() == [(1, "a", 1, 1), (10, "a", 1, 1), (8, "a", 1, 1)]
    assert place.report() == (6, 3, 2, 1)


def test_an_open_window_lives_through_calls(place):
    for hour in range(5):
        place.land((f"01 0{hour}:00:00", "a", 1))
        place.follow()
    assert place.found() == [(1, "a", 5, 5)] and place.report() == (5, 5, 0, 0)


@pytest.mark.parametrize("table", [windows.TALLY, windows.WINDOWS])
def test_a_batch_that_was_published_but_not_checkpointed(spark, place, monkeypatch, table):
    place.land(("01 10:00:00", "a", 1))
    place.follow()
    place.land(("01 11:00:00", "a", 2), ("02 11:00:00", "b", 3))
    publish = EventWindows._publish

    def crashes(self, lake, name, *args):
        publish(self, lake, name, *args)
        if name == table:
            raise OSError("after the commit")

    with monkeypatch.context() as patch:
        patch.setattr(EventWindows, "_publish", crashes)
        with pytest.raises(StreamingQueryException):
            place.follow()
    place.follow()
    assert place.found() == [(1, "a", 2, 3), (2, "b", 1, 3)]
    assert place.report() == (3, 3, 0, 0)


def test_many_parts_become_one(place, monkeypatch):
    monkeypatch.setattr(windows, "_MERGE_AFTER", 2)
    for hour in range(5):
        place.land((f"0{1 + hour % 2} 0{hour}:00:00", "a", 1))
        place.follow()
    assert len(place.lake.current().parts["windows"]) <= 2 and len(place.lake.current().parts["tally"]) <= 2
    assert place.found() == [(1, "a", 3, 3), (2, "a", 2, 2)] and place.report() == (5, 5, 0, 0)


def test_nothing_landed(place):
    assert place.found() == [] and place.report() == (0, 0, 0, 0)
