"""Column expressions: Column in, Column out, all evaluated inside the JVM."""

from ledgerloom.functions.conform import gender_code
from ledgerloom.functions.money import (
    amount_cents,
    cent_parts,
    cents_to_amount,
    inexact_amount,
    mean_amount,
    order_amount,
    round_cents,
    sum_cents,
    total_amount,
)
from ledgerloom.functions.rules import is_bad_record, quality_rules

__all__ = [
    "amount_cents",
    "cent_parts",
    "cents_to_amount",
    "gender_code",
    "inexact_amount",
    "is_bad_record",
    "mean_amount",
    "order_amount",
    "quality_rules",
    "round_cents",
    "sum_cents",
    "total_amount",
]
