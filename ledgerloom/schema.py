"""Table schemas of the raw, bronze, silver, quarantine and gold layers."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def _schema(*columns: tuple[str, type]) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in columns])


# The 16 columns of a retail transaction, in file order.
RAW_SCHEMA = _schema(
    ("transaction_id", LongType),
    ("order_date", StringType),
    ("ship_date", StringType),
    ("customer_id", StringType),
    ("customer_age", LongType),
    ("gender", StringType),
    ("product_id", StringType),
    ("product_category", StringType),
    ("quantity", LongType),
    ("unit_price", DoubleType),
    ("discount_pct", DoubleType),
    ("city", StringType),
    ("state", StringType),
    ("payment_type", StringType),
    ("order_status", StringType),
    ("ingestion_date", StringType),
)

BRONZE_SCHEMA = RAW_SCHEMA
SILVER_SCHEMA = RAW_SCHEMA
QUARANTINE_SCHEMA = RAW_SCHEMA

# The three gold marts.
DAILY_SALES_SCHEMA = _schema(
    ("order_date", StringType),
    ("total_revenue", DoubleType),
    ("total_orders", LongType),
    ("avg_order_value", DoubleType),
)
PRODUCT_PERFORMANCE_SCHEMA = _schema(
    ("product_category", StringType),
    ("category_revenue", DoubleType),
    ("total_units_sold", LongType),
    ("order_count", LongType),
)
CITY_REVENUE_SCHEMA = _schema(
    ("city", StringType),
    ("state", StringType),
    ("city_revenue", DoubleType),
    ("order_count", LongType),
    ("avg_order_value", DoubleType),
)

GOLD_SCHEMAS = {
    "daily_sales_metrics": DAILY_SALES_SCHEMA,
    "product_performance": PRODUCT_PERFORMANCE_SCHEMA,
    "city_revenue": CITY_REVENUE_SCHEMA,
}
