"""Reading the given tables, and intermediate tables that survive a lost executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BITMAP = 32_768  # bits of one bitmap of bitmap_construct_agg, 4 KB
_BITMAPS = 2_048
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a folder of its own, kept in the
    setting so that later calls use the same one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("ledgerloom.llm.scratch", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="ledgerloom-llm-")
        spark.conf.set("ledgerloom.llm.scratch", found)
    return found.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at once by bytes, not only by rows, unless the session has a bound already.

    10,000 whole texts, Spark's bound, may be gigabytes.
    """
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, "4m")


class Scratch:
    """Names new tables below one folder of the shared directory and deletes superseded ones."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self.written = 0

    def write(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Writes ``df`` as Parquet and reads it back: lineage ends here."""
        path = f"{self.root}/{self.written}"
        self.written += 1
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        found.scratch_path = path
        return found

    def drop(self, df: DataFrame) -> None:
        """Deletes a table of :meth:`write` that no later plan reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def with_likely(rows: DataFrame, ids: DataFrame, column: str, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: false only where ``column`` is none of ``ids``, and mostly so there.

    Ids set bits by hash in 8 MB of bitmaps, whatever their number, which are broadcast. With very many ids
    all bits are set and every row may be one of them; what follows on the likely rows has to be exact.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(_BITMAP * _BITMAPS))
    bucket, position = F.call_function("div", slot, F.lit(_BITMAP)), slot % _BITMAP
    bitmaps = ids.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(position).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (position % 8).cast("int") + 1)
    # At most _BITMAPS rows of 4 KB.
    near = rows.join(F.broadcast(bitmaps), bucket == F.col("_bucket"), "left")
    return near.select(*rows.columns, F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False)).alias(flag))


def likely_among(rows: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """The rows of ``rows`` whose ``column`` may be one of ``ids``; those that are stay, most others go.

    An exact join may follow, and then deals little but what it keeps.
    """
    return with_likely(rows, ids, column, "_likely").where("_likely").drop("_likely")
