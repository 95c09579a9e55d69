"""Seeded synthetic transactions.

Every value is a mix of (seed, record id, column number) in whole numbers below
2**31, which any SQL engine can repeat, so the same seed
gives the same rows for any number of partitions, and a recomputed partition
after a lost executor gives the rows it gave before. ``rand(seed)`` does not:
it depends on the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schema import RAW_SCHEMA

# Domains of the generated columns. Integer ranges are half-open.
CATEGORY_PRICES = {
    "Fashion": (20, 500),
    "Grocery": (1, 50),
    "Furniture": (50, 1500),
    "Sports": (10, 800),
}
CITIES = [
    ("New York", "NY"),
    ("Los Angeles", "CA"),
    ("Chicago", "IL"),
    ("Houston", "TX"),
    ("Phoenix", "AZ"),
]
PAYMENT_TYPES = ["Card", "UPI", "COD", "Crypto", None]
GENDERS = ["M", "F", "Male", "Female", None]
ORDER_STATUSES = ["Delivered", "Cancelled", "Returned"]
FIRST_DATE = "2023-01-01"
DATE_COUNT = 1096
SHIP_DELAY_RANGE = (-3, 10)
TRANSACTION_ID_RANGE = (1, 100_000_000)
CUSTOMER_RANGE = (1, 200_000)
PRODUCT_RANGE = (1, 50_000)
AGE_RANGE = (10, 100)
QUANTITY_RANGE = (1, 10)
MAX_DISCOUNT_PCT = 50

# Column numbers that feed the hash; a number is never reused.
DRAWS = {
    "transaction_id": 1,
    "order_date": 2,
    "ship_delay": 3,
    "customer_id": 4,
    "customer_age": 5,
    "gender": 6,
    "product_id": 7,
    "product_category": 8,
    "quantity": 9,
    "unit_price": 10,
    "discount_pct": 11,
    "city": 12,
    "payment_type": 13,
    "order_status": 14,
    "defect": 15,
    "defect_kind": 16,
}
DEFECT_SCALE = 1_000_000

# Constants of the mix; products stay within a bigint.
MODULUS = 2**31 - 1
MULTIPLIERS = (1103515245, 1597334677, 1812433253, 1664525093)
SHIFTS = (15, 13, 16)
DRAW_STEP = 12_347
ROWS_PER_PARTITION = 5_000_000


def _pick(values: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def draw_offset(seed: int, name: str) -> int:
    """What sets the draws of one seed and column apart from others."""
    return (seed * 1_000_003 + DRAWS[name] * 715_827_883) % MODULUS


def _mixed(ids: DataFrame, id_column: str, seed: int) -> DataFrame:
    """A column of mixed bits for each draw of a record.

    Each step of the mix is a projection of its own: it uses what the one before gives twice, and
    Spark keeps such projections apart instead of writing the steps into one another.
    """

    def whole(value: int) -> Column:
        return F.lit(value).cast("bigint")

    record = F.col(id_column).cast("bigint")
    low, high = F.pmod(record, whole(MODULUS)), F.call_function("div", record, whole(MODULUS))
    rows = ids.select(low.alias("_low"), high.alias("_high"))
    first = F.col("_low") * whole(MULTIPLIERS[0]) + F.col("_high") * whole(DRAW_STEP)
    rows = rows.select(*[F.pmod(first + whole(draw_offset(seed, name)), whole(MODULUS)).alias(name) for name in DRAWS])
    for shift, multiplier in zip(SHIFTS, MULTIPLIERS[1:], strict=True):
        mixed = [F.pmod(F.col(name).bitwiseXOR(F.shiftright(name, shift)) * whole(multiplier), whole(MODULUS)) for name in DRAWS]
        rows = rows.select(*[m.alias(name) for m, name in zip(mixed, DRAWS, strict=True)])
    return rows


def _draw(name: str, start: int, stop: int | Column) -> Column:
    """An integer in [start, stop) from a draw's mixed bits."""
    low = F.lit(start).cast("bigint")
    return low + F.pmod(F.col(name), stop - low)


def transactions_for_ids(
    ids: DataFrame,
    id_column: str,
    *,
    seed: int,
    ingestion_date: str,
    bad_rate: float = 0.0,
) -> DataFrame:
    """One transaction for every row of ``ids``; a narrow projection, no shuffle.

    ``bad_rate`` is the share of records given one defect (quantity, age or
    price out of range, or a NULL in one of them), to exercise the quality
    rules. With 0 only ages below the minimum occur.
    """
    # First the indexes that several columns share, then the columns.
    draw = _draw
    base = _mixed(ids, id_column, seed).select(
        "*",
        draw("order_date", 0, DATE_COUNT).cast("int").alias("_day"),
        draw("product_category", 0, len(CATEGORY_PRICES)).alias("_category"),
        draw("city", 0, len(CITIES)).alias("_city"),
    )

    def choice(name: str, values: list) -> Column:
        return _pick(values, draw(name, 0, len(values)))

    order_day = F.date_add(F.lit(FIRST_DATE).cast("date"), F.col("_day"))
    ship_delay = draw("ship_delay", *SHIP_DELAY_RANGE).cast("int")
    low_cents = _pick([low * 100 for low, _ in CATEGORY_PRICES.values()], F.col("_category"))
    span_cents = _pick(
        [(high - low) * 100 + 1 for low, high in CATEGORY_PRICES.values()], F.col("_category")
    )
    price_cents = low_cents + draw("unit_price", 0, span_cents)

    columns = {
        "transaction_id": draw("transaction_id", *TRANSACTION_ID_RANGE),
        "order_date": order_day.cast("string"),
        "ship_date": F.date_add(order_day, ship_delay).cast("string"),
        "customer_id": F.concat(F.lit("CUST"), draw("customer_id", *CUSTOMER_RANGE)),
        "customer_age": draw("customer_age", *AGE_RANGE),
        "gender": choice("gender", GENDERS),
        "product_id": F.concat(F.lit("PROD"), draw("product_id", *PRODUCT_RANGE)),
        "product_category": _pick(list(CATEGORY_PRICES), F.col("_category")),
        "quantity": draw("quantity", *QUANTITY_RANGE),
        "unit_price": price_cents / 100,
        "discount_pct": draw("discount_pct", 0, MAX_DISCOUNT_PCT * 100 + 1) / 100,
        "city": _pick([city for city, _ in CITIES], F.col("_city")),
        "state": _pick([state for _, state in CITIES], F.col("_city")),
        "payment_type": choice("payment_type", PAYMENT_TYPES),
        "order_status": choice("order_status", ORDER_STATUSES),
        "ingestion_date": F.lit(ingestion_date),
    }
    if bad_rate:
        columns |= _defects(columns, draw, bad_rate)
    return base.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]
    )


def _defects(
    columns: dict[str, Column], draw: Callable[..., Column], bad_rate: float
) -> dict[str, Column]:
    """The columns that the quality rules test, damaged in a share of the records."""
    hit = draw("defect", 0, DEFECT_SCALE) < round(bad_rate * DEFECT_SCALE)
    kind = draw("defect_kind", 0, 6)
    replacements = {
        "quantity": {0: -columns["quantity"], 1: F.lit(None)},
        "customer_age": {2: columns["customer_age"] + 101, 3: F.lit(None)},
        "unit_price": {4: F.lit(0.0), 5: F.lit(None)},
    }
    damaged = {}
    for name, by_kind in replacements.items():
        value = columns[name]
        for number, bad in by_kind.items():
            value = F.when(hit & (kind == number), bad).otherwise(value)
        damaged[name] = value
    return damaged


def generate_transactions(
    spark: SparkSession,
    num_records: int,
    *,
    seed: int,
    ingestion_date: str,
    bad_rate: float = 0.0,
    num_partitions: int | None = None,
) -> DataFrame:
    """``num_records`` synthetic transactions, computed where they are written.

    By default no partition has more than ``ROWS_PER_PARTITION`` records, which
    is what a lost task costs.
    """
    if num_partitions is None:
        needed = -(-num_records // ROWS_PER_PARTITION)
        num_partitions = max(needed, spark.sparkContext.defaultParallelism)
    ids = spark.range(0, num_records, 1, num_partitions)
    return transactions_for_ids(
        ids, "id", seed=seed, ingestion_date=ingestion_date, bad_rate=bad_rate
    )
