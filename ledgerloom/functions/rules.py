"""Data-quality rules of a transaction.

The rules keep SQL's three-valued logic. A NULL in a tested column makes its
rule NULL; a record is bad as soon as one rule is TRUE, valid when all are
FALSE, and undecided otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted age range, both ends included.
MIN_AGE = 15
MAX_AGE = 100


def quality_rules() -> dict[str, Column]:
    """Rule name -> condition that is TRUE for a record breaking the rule."""
    return {
        "quantity_not_positive": F.col("quantity") <= 0,
        "age_below_min": F.col("customer_age") < MIN_AGE,
        "age_above_max": F.col("customer_age") > MAX_AGE,
        "price_not_positive": F.col("unit_price") <= 0,
    }


def is_bad_record() -> Column:
    """TRUE, FALSE or NULL: at least one rule is broken."""
    return reduce(or_, quality_rules().values())
