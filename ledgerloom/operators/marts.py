"""Gold marts.

Each mart is a plain group-by with map-side partial aggregation over additive
integer measures, so a city or a day that holds a third of all sales reaches
the reducers as one partial row per map task.

``mart_rollup`` computes the measures of all three marts in one scan of silver
and ``marts_from_rollup`` cuts the marts from its (small) result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.money import (
    cent_parts,
    inexact_amount,
    mean_amount,
    order_amount,
    sum_cents,
    total_amount,
)

# Mart name -> grouping keys.
MART_KEYS = {
    "daily_sales_metrics": ["order_date"],
    "product_performance": ["product_category"],
    "city_revenue": ["city", "state"],
}


def with_total_amount(df: DataFrame) -> DataFrame:
    """Appends ``total_amount``; NULL when an input is NULL."""
    return df.withColumn(
        "total_amount",
        order_amount(F.col("quantity"), F.col("unit_price"), F.col("discount_pct")),
    )


def with_cents(silver: DataFrame) -> DataFrame:
    """Appends ``total_amount``, its exact cents in two parts, and the amount itself where it has none."""
    high, low = cent_parts(F.col("total_amount"))
    amounts = with_total_amount(silver).withColumns({"_high": high, "_low": low})
    return amounts.withColumn("_inexact", inexact_amount(F.col("total_amount"), F.col("_low")))


def _measures() -> list[Column]:
    """Additive measures. Orders with a NULL id count as revenue, not as orders;
    the mean is taken over the amounts that are known, not over the orders."""
    return [
        sum_cents(F.col("_high"), F.col("_low")).alias("cents"),
        F.sum("_inexact").alias("inexact"),
        F.count("total_amount").alias("amounts"),
        F.sum("quantity").alias("units"),
        F.count("transaction_id").alias("orders"),
    ]


def _mart_columns(mart: str) -> list[Column]:
    revenue = total_amount(F.col("cents"), F.col("inexact"))
    mean = mean_amount(F.col("cents"), F.col("amounts"), F.col("inexact"))
    orders, units = F.col("orders"), F.col("units")
    values = {
        "daily_sales_metrics": {
            "total_revenue": revenue,
            "total_orders": orders,
            "avg_order_value": mean,
        },
        "product_performance": {
            "category_revenue": revenue,
            "total_units_sold": units,
            "order_count": orders,
        },
        "city_revenue": {
            "city_revenue": revenue,
            "order_count": orders,
            "avg_order_value": mean,
        },
    }[mart]
    keys = [F.col(key) for key in MART_KEYS[mart]]
    return keys + [value.alias(name) for name, value in values.items()]


def _mart(silver: DataFrame, mart: str) -> DataFrame:
    grouped = with_cents(silver).groupBy(*MART_KEYS[mart]).agg(*_measures())
    return grouped.select(*_mart_columns(mart))


def daily_sales_metrics(silver: DataFrame) -> DataFrame:
    """Revenue, orders and mean order value per ``order_date``."""
    return _mart(silver, "daily_sales_metrics")


def product_performance(silver: DataFrame) -> DataFrame:
    """Revenue, units and orders per ``product_category``."""
    return _mart(silver, "product_performance")


def city_revenue(silver: DataFrame) -> DataFrame:
    """Revenue, orders and mean order value per city and state."""
    return _mart(silver, "city_revenue")


def mart_name() -> Column:
    """In an aggregation by the grouping sets of the marts, the mart of a group."""
    return F.coalesce(*[F.when(F.grouping(keys[0]) == 0, F.lit(mart)) for mart, keys in MART_KEYS.items()])


def mart_rollup(silver: DataFrame) -> DataFrame:
    """Measures of every mart's groups, from a single scan of silver.

    GROUPING SETS of the three keys: the result has as many rows as the three
    marts together, not as many as the combinations of their keys. The amount
    is computed once per row, below the expansion. ``mart`` names the group's
    mart, because a key may itself be NULL.
    """
    keys = [key for mart_keys in MART_KEYS.values() for key in mart_keys]
    sets = [[F.col(key) for key in mart_keys] for mart_keys in MART_KEYS.values()]
    columns = [F.col(key) for key in keys]
    return (
        with_cents(silver)
        .groupingSets(sets, *columns)
        .agg(mart_name().alias("mart"), *_measures())
    )


def marts_from_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """Mart name -> mart, from the result of ``mart_rollup``."""
    return {
        mart: rollup.filter(F.col("mart") == mart).select(*_mart_columns(mart))
        for mart in MART_KEYS
    }
