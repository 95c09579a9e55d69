"""Times the registered queries and prints one JSON line.

Environment: BENCH_SF_DIR (data directory), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query after one warm-up run; the median counts).

``python bench.py compare ROWS`` instead times the whole pipeline over that many generated rows against
the same layers built one plain statement after another, in alternation, and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import gender_code, is_bad_record
from ledgerloom.plans import LayerPaths, run_pipeline
from ledgerloom.queries import QUERIES
from ledgerloom.schema import RAW_SCHEMA
from ledgerloom.sources import generate_transactions, land_run

# One query stands for others that run the same jobs.
UNTIMED = {
    "pipeline_counts",
    "pipeline_daily_sales_metrics",
    "pipeline_product_performance",
    "incremental_quarantine",
    "incremental_rollup",
    "triage_report",
    "event_report",
    "profile_drift",
}
HEADLINE = [name for name in QUERIES if name not in UNTIMED]


def run(df: DataFrame) -> None:
    """Computes every row and column, and keeps none."""
    df.write.format("noop").mode("overwrite").save()


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerloom-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def plain_pipeline(spark: SparkSession, paths: LayerPaths) -> None:
    """The layers without this package's jobs: one file of bad rows, rows dropped by key, a scan for each mart."""
    spark.read.schema(RAW_SCHEMA).parquet(f"{paths.raw}/*").write.mode("overwrite").parquet(paths.bronze)
    spark.read.parquet(paths.bronze).count()
    bronze = spark.read.parquet(paths.bronze)
    valid, bad = bronze.filter(~is_bad_record()), bronze.filter(is_bad_record())
    silver = valid.withColumn("gender", gender_code(F.col("gender"))).dropDuplicates(["transaction_id"])
    silver.write.mode("overwrite").parquet(paths.silver)
    bad.count()
    bad.coalesce(1).write.mode("overwrite").option("header", True).csv(paths.quarantine)
    sales = spark.read.parquet(paths.silver)
    sales = sales.withColumn("amount", F.round(F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct") / 100), 2))
    revenue, orders = F.round(F.sum("amount"), 2).alias("revenue"), F.count("transaction_id").alias("orders")
    mean = F.round(F.avg("amount"), 2).alias("mean")
    marts = {
        "daily_sales_metrics": (["order_date"], [revenue, orders, mean]),
        "product_performance": (["product_category"], [revenue, F.sum("quantity").alias("units"), orders]),
        "city_revenue": (["city", "state"], [revenue, orders, mean]),
    }
    for name, (keys, measures) in marts.items():
        sales.groupBy(*keys).agg(*measures).write.mode("overwrite").parquet(f"{paths.gold}/{name}")


def compare(rows: int, runs: int) -> dict:
    spark = session()
    with tempfile.TemporaryDirectory(prefix="ledgerloom-bench-") as root:
        ours, plain = (LayerPaths.under(f"{root}/{name}") for name in ("ours", "plain"))
        made = generate_transactions(spark, rows, seed=1, ingestion_date="2026-01-01")
        for paths in (ours, plain):
            land_run(made, paths.raw, "run_1")
        seconds = {"ours": [], "plain": []}
        for _ in range(runs + 1):
            seconds["ours"].append(timed(lambda: run_pipeline(spark, ours)))
            seconds["plain"].append(timed(lambda: plain_pipeline(spark, plain)))
        spark.stop()
    middle = {name: round(statistics.median(values[1:]), 3) for name, values in seconds.items()}
    return {"rows": rows, "runs": runs, "seconds": middle, "ratio": round(middle["ours"] / middle["plain"], 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    if sys.argv[1:2] == ["compare"]:
        print(json.dumps(compare(int(sys.argv[2]), runs)))
        return
    spark = session()
    seconds = {}
    for name in HEADLINE:
        each = [timed(lambda: run(QUERIES[name](spark, sf_dir))) for _ in range(runs + 1)]
        seconds[name] = round(statistics.median(each[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(os.environ.get("BENCH_CPUS", "8")),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
