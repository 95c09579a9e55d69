from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ledgerloom.schema import RAW_SCHEMA  # noqa: E402

TESTDATA = os.environ.get("LEDGERLOOM_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small_dir() -> str:
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def transactions(spark):
    """Builds raw transactions from dicts; columns left out get plain valid values."""
    plain = {
        "transaction_id": 1,
        "order_date": "2024-01-01",
        "ship_date": "2024-01-03",
        "customer_id": "CUST1",
        "customer_age": 30,
        "gender": "M",
        "product_id": "PROD1",
        "product_category": "Sports",
        "quantity": 1,
        "unit_price": 1.0,
        "discount_pct": 0.0,
        "city": "Chicago",
        "state": "IL",
        "payment_type": "Card",
        "order_status": "Delivered",
        "ingestion_date": "2026-01-01",
    }

    def build(*rows: dict) -> DataFrame:
        values = [tuple((plain | row)[name] for name in RAW_SCHEMA.fieldNames()) for row in rows]
        return spark.createDataFrame(values, RAW_SCHEMA)

    return build


def sorted_rows(df: DataFrame) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().toString()
