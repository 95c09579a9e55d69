"""Value standardisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def gender_code(gender: Column) -> Column:
    """``M``, ``F`` or ``Unknown``; never NULL.

    Case and surrounding spaces are ignored. ``trim`` strips spaces only, so a
    value padded with a tab is ``Unknown``, as are NULL and the empty string.
    """
    spelled = F.upper(F.trim(gender))
    # Accepted spellings and output codes.
    return (
        F.when(spelled.isin("MALE", "M"), F.lit("M"))
        .when(spelled.isin("FEMALE", "F"), F.lit("F"))
        .otherwise(F.lit("Unknown"))
    )
