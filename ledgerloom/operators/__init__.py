"""DataFrame -> DataFrame operators; all lazy, none triggers a job."""

from ledgerloom.operators.asof import asof_join
from ledgerloom.operators.conform import clean_silver, dedup_transactions, standardize_gender
from ledgerloom.operators.layout import clustered, dealt_evenly, files_by_extent
from ledgerloom.operators.mart_state import change_partials, mart_partials, merge_partials, rollup_from_state
from ledgerloom.operators.marts import (
    city_revenue,
    daily_sales_metrics,
    mart_rollup,
    marts_from_rollup,
    product_performance,
    with_total_amount,
)
from ledgerloom.operators.quality import QualitySplit, dq_counts, dq_report, split_quality
from ledgerloom.operators.sketches import column_profiles, describe_profiles, merge_profiles, profile_drift

__all__ = [
    "QualitySplit",
    "asof_join",
    "change_partials",
    "city_revenue",
    "clean_silver",
    "clustered",
    "column_profiles",
    "daily_sales_metrics",
    "dealt_evenly",
    "dedup_transactions",
    "describe_profiles",
    "dq_counts",
    "dq_report",
    "files_by_extent",
    "mart_partials",
    "mart_rollup",
    "marts_from_rollup",
    "merge_partials",
    "merge_profiles",
    "product_performance",
    "profile_drift",
    "rollup_from_state",
    "split_quality",
    "standardize_gender",
    "with_total_amount",
]
