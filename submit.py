"""Command line of the jobs, for spark-submit.

    spark-submit submit.py generate --root s3a://bucket/lake --run-id 20260101_000000 \\
        --records 1000000 --seed 1 --ingestion-date 2026-01-01
    spark-submit submit.py bronze   --root s3a://bucket/lake
    spark-submit submit.py ingest   --root s3a://bucket/lake --checkpoint s3a://bucket/state
    spark-submit submit.py silver   --root s3a://bucket/lake
    spark-submit submit.py gold     --root s3a://bucket/lake
    spark-submit submit.py pipeline --root s3a://bucket/lake

``pipeline`` runs bronze, silver and gold. With ``--input-bytes`` and ``--cores`` the session gets the
settings of ``plans.session_settings``; master, memory and credentials come from the submission.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from ledgerloom.plans import (
    LayerPaths,
    bronze_to_silver,
    land,
    raw_to_bronze,
    run_pipeline,
    session_settings,
    silver_to_gold,
)
from ledgerloom.sources import generate_transactions
from ledgerloom.sources.parquet import ROWS_PER_FILE
from ledgerloom.sources.quarantine import QUARANTINE_ROWS_PER_FILE
from ledgerloom.streaming import ingest_new_runs


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help)
        sub.add_argument("--root", required=True, help="folder that holds the layers")
        sub.add_argument("--input-bytes", type=int, help="size of the Parquet files that are read")
        sub.add_argument("--cores", type=int, help="cores of all executors")
        return sub

    generate = command("generate", "land one run of synthetic transactions")
    generate.add_argument("--run-id", required=True)
    generate.add_argument("--records", type=int, required=True)
    generate.add_argument("--seed", type=int, required=True)
    generate.add_argument("--ingestion-date", required=True)
    generate.add_argument("--bad-rate", type=float, default=0.0)
    generate.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    bronze = command("bronze", "rebuild bronze from all landed runs")
    bronze.add_argument("--recursive", action="store_true")
    ingest = command("ingest", "append newly landed files to bronze")
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--max-files-per-trigger", type=int, default=10_000)
    silver = command("silver", "rebuild silver and the quarantine from bronze")
    command("gold", "rebuild the marts from silver")
    pipeline = command("pipeline", "bronze, silver and gold from all landed runs")
    for sub in (silver, pipeline):
        sub.add_argument("--quarantine-rows-per-file", type=int, default=QUARANTINE_ROWS_PER_FILE)
    args = parser.parse_args(argv)
    if (args.input_bytes is None) != (args.cores is None):
        parser.error("--input-bytes and --cores go together")
    return args


def settings(args: argparse.Namespace) -> dict[str, str]:
    """What the session is built with, besides the submission's settings."""
    return {} if args.cores is None else session_settings(args.input_bytes, args.cores)


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    """Runs one command; returns its counts."""
    paths = LayerPaths.under(args.root)
    match args.command:
        case "generate":
            rows = generate_transactions(
                spark,
                args.records,
                seed=args.seed,
                ingestion_date=args.ingestion_date,
                bad_rate=args.bad_rate,
            )
            return land(rows, paths.raw, args.run_id, rows_per_file=args.rows_per_file)
        case "bronze":
            return raw_to_bronze(spark, paths.raw, paths.bronze, recursive=args.recursive)
        case "ingest":
            ingest_new_runs(
                spark,
                paths.raw,
                paths.bronze,
                args.checkpoint,
                max_files_per_trigger=args.max_files_per_trigger,
            )
        case "silver":
            return bronze_to_silver(
                spark,
                paths.bronze,
                paths.silver,
                paths.quarantine,
                quarantine_rows_per_file=args.quarantine_rows_per_file,
            )
        case "gold":
            silver_to_gold(spark, paths.silver, paths.gold)
        case "pipeline":
            return run_pipeline(spark, paths, quarantine_rows_per_file=args.quarantine_rows_per_file)
    return {}


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"ledgerloom-{args.command}").config(map=settings(args)).getOrCreate()
    try:
        print(json.dumps({"command": args.command} | run(spark, args)))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
