"""Retail transactions derived from the order tables of a TPC-H-like schema.

One transaction per order line. The expressions plant what the pipeline has to
deal with: repeated ids, NULLs and out-of-range values in the tested columns,
and differently spelled genders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schema import RAW_SCHEMA

INGESTION_DATE = "2026-01-01"

# The columns in use of each table. Declared, so no footer is read for them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double,"
        " l_discount double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
}

# How each column is derived.
COLUMN_EXPRESSIONS = {
    "transaction_id": "l_orderkey * 10 + l_linenumber",
    "order_date": "cast(cast(o_orderdate as date) as string)",
    "ship_date": "cast(cast(l_shipdate as date) as string)",
    "customer_id": "concat('CUST', cast(o_custkey as string))",
    "customer_age": "case when o_custkey % 37 = 0 then null else 10 + o_custkey % 95 end",
    "gender": (
        "case (l_orderkey + l_linenumber) % 8 when 0 then 'M' when 1 then 'F' when 2 then 'Male'"
        " when 3 then 'Female' when 4 then ' male ' when 5 then 'FEMALE' when 6 then 'X'"
        " else null end"
    ),
    "product_id": "concat('PROD', cast(l_partkey as string))",
    "product_category": "p_type",
    "quantity": (
        "case when l_partkey % 97 = 0 then null"
        " when l_partkey % 53 = 0 then 0 - cast(l_quantity as bigint)"
        " else cast(l_quantity as bigint) end"
    ),
    "unit_price": "case when l_partkey % 61 = 0 then cast(0 as double) else p_retailprice end",
    "discount_pct": "case when l_partkey % 89 = 0 then null else l_discount * 100 end",
    "city": "n_name",
    "state": "r_name",
    "payment_type": "case when o_orderpriority = '5-LOW' then null else o_orderpriority end",
    "order_status": (
        "case l_returnflag when 'A' then 'Cancelled' when 'R' then 'Returned'"
        " else 'Delivered' end"
    ),
    "ingestion_date": f"'{INGESTION_DATE}'",
}


def retail_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw retail transactions of the tables in ``sf_dir``.

    Orders meet their customer and place before the order lines, so that join
    moves orders and not the several times more numerous lines. Lines meet
    their part first, which adds least to the rows of the next shuffle. Every
    side has the columns in use only, and the right side of a join is a plain
    table where possible: Spark knows its size and decides on broadcasting.
    """

    def table(name: str) -> DataFrame:
        return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    def equal(left: str, right: str) -> Column:
        return F.col(left) == F.col(right)

    orders = (
        table("orders")
        .join(table("customer"), equal("o_custkey", "c_custkey"))
        .join(table("nation"), equal("c_nationkey", "n_nationkey"))
        .join(table("region"), equal("n_regionkey", "r_regionkey"))
    )
    lines = table("lineitem").join(table("part"), equal("l_partkey", "p_partkey"))
    joined = lines.join(orders, equal("l_orderkey", "o_orderkey"))
    return joined.select(
        *[F.expr(COLUMN_EXPRESSIONS[f.name]).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]
    )
