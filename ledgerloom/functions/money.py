"""Exact money arithmetic.

An order amount is a double with two decimals. Sums and means of doubles depend
on the order in which partial results meet, so amounts are aggregated as whole
cents: every regrouping, retry or partition count gives the same result. A row's cents are
two bigints, which Spark adds up several times faster than decimals; a group's are one decimal. Amounts that have no exact cents (NaN, infinite, or of 1e18 and more)
are summed apart, as doubles, and show in the result as they would in a sum of
doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_amount(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """Discounted value of one order line, rounded half-up to two decimals."""
    return round_cents(quantity * unit_price * (F.lit(1) - discount_pct / 100))


def round_cents(value: Column) -> Column:
    """``F.round(value, 2)`` to the bit, at a third of its time.

    Spark rounds a double by its decimal digits. That can differ from the nearest whole number of cents only next to a tie, so
    only there, and where a double no longer holds the fourth decimal, are the digits looked at.
    """
    cents = value * 100
    nearest = F.rint(cents)
    plain = (F.abs(cents) < 1e11) & (F.abs(cents - nearest) < 0.4999)
    # Minus zero is zero.
    return F.when(plain, (nearest + F.lit(0.0)) / 100).otherwise(F.round(value, 2))


def amount_cents(amount: Column) -> Column:
    """Whole cents of a two-decimal amount, as a decimal whose sums hold 10**18 of the largest.

    NULL for NaN, infinite amounts and those of 1e18 and more. ``rint`` only
    removes the binary noise of ``amount * 100``: the true product is an
    integer, so no tie can occur.
    """
    return F.rint(amount * 100).try_cast("decimal(20,0)").cast("decimal(28,0)")


_LOW = 2**32


def cent_parts(amount: Column) -> tuple[Column, Column]:
    """The cents of ``amount_cents`` as ``high * 2**32 + low``, both bigint and of the amount's sign.

    ``high`` is 0 below 43 million. Sums of either hold two billion of the largest; beyond that Spark reports an overflow.
    """
    cents = F.rint(amount * 100)
    exact = F.when(F.abs(cents) < 1e20, cents)
    high = F.when(F.abs(exact) < _LOW, F.lit(0).cast("bigint")).otherwise((exact / _LOW).cast("bigint"))
    # Both are whole multiples of the last bit of a double, so that nothing is rounded.
    return high, (exact - high * F.lit(float(_LOW))).cast("bigint")


def sum_cents(high: Column, low: Column) -> Column:
    """A group's cents as a decimal, from its rows' parts; NULL without any."""
    return (F.sum(high).cast("decimal(20,0)") * F.lit(_LOW).cast("decimal(10,0)") + F.sum(low).cast("decimal(20,0)")).cast("decimal(38,0)")


def inexact_amount(amount: Column, cents: Column) -> Column:
    """The amount itself where it is known but has no exact cents."""
    return F.when(cents.isNull(), amount)


def cents_to_amount(cents: Column) -> Column:
    """Double with two decimals from whole cents."""
    return cents.cast("double") / 100


def total_amount(cents: Column, inexact: Column) -> Column:
    """Sum of amounts from the sums of their exact cents and of what has none; NULL without either."""
    exact = cents_to_amount(cents)
    return F.when(inexact.isNull(), exact).otherwise(inexact + F.coalesce(exact, F.lit(0.0)))


def mean_amount(cents: Column, count: Column, inexact: Column | None = None) -> Column:
    """Mean amount, rounded half-up (away from zero) to a cent in whole numbers.

    NULL when nothing was counted. With ``inexact``, the sum of amounts that have
    no exact cents, it is the rounded quotient of doubles.
    """
    size = F.abs(cents)
    n = F.nullif(count, F.lit(0)).cast("decimal(20,0)")
    rest = size % n
    whole = ((size - rest) / n).cast("decimal(38,0)")
    rounded = whole + F.when(rest >= n - rest, 1).otherwise(0).cast("decimal(1,0)")
    mean = cents_to_amount(F.when(cents < 0, -rounded).otherwise(rounded))
    if inexact is None:
        return mean
    return F.when(inexact.isNull(), mean).otherwise(F.round(total_amount(cents, inexact) / count, 2))
