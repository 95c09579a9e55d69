"""Jobs that read one layer and write the next."""

from ledgerloom.plans.incremental import (
    apply_batch,
    current_marts,
    current_quarantine,
    current_rollup,
    current_silver,
    follow_runs,
    rebuild,
)
from ledgerloom.plans.jobs import (
    LayerPaths,
    bronze_to_silver,
    land,
    raw_to_bronze,
    run_pipeline,
    silver_to_gold,
)
from ledgerloom.plans.sizing import session_settings

__all__ = [
    "LayerPaths",
    "apply_batch",
    "bronze_to_silver",
    "current_marts",
    "current_quarantine",
    "current_rollup",
    "current_silver",
    "follow_runs",
    "land",
    "raw_to_bronze",
    "rebuild",
    "run_pipeline",
    "session_settings",
    "silver_to_gold",
]
