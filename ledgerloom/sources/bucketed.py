"""Tables that are shuffled once, when they are written: bucketed by key and sorted within a bucket.

Spark knows the buckets from its catalog. What needs the rows of a key together later (a second de-duplication, joins and
groupings by the key) reads them in place, without an exchange, as often as it is done. Two tables meet without
one if they have the same number of buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators.conform import KEY


def write_bucketed(df: DataFrame, name: str, path: str, *, buckets: int, key: str = KEY) -> DataFrame:
    """Replaces the catalog's table ``name``, with its files at ``path``, and returns it.

    A task of the write holds exactly one bucket, so that there is one file for each bucket that has rows. All rows of a key are in one
    bucket; one that would hold too many belongs in a table without buckets.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Takes the table out of the catalog; its files stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def exchanges(df: DataFrame) -> int:
    """How many times the physical plan of ``df`` moves rows between tasks (broadcasts not counted)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "BroadcastExchange" not in line for line in plan.splitlines())
