"""Relational operators: quality (P*), matching (J*), dedup (D*),
aggregates (A*) and ordered windows (W*)."""

from tallyflow.operators.aggregates import (
    device_minute_turnover,
    minutes_seen,
    minutes_seen_approx,
    platform_minute_turnover,
)
from tallyflow.operators.dedup import D1_KEYS, changed_payments, distinct_payments
from tallyflow.operators.matching import (
    first_orders,
    match_arrived,
    match_by_set,
    match_payments,
    pending_payments,
)
from tallyflow.operators.quality import (
    for_platform,
    positive_payments,
    reconcile_order_payments,
    rejected_payments,
)
from tallyflow.operators.windows import (
    cumulative_turnover,
    island_totals,
    previous_value,
    running_aggregate,
    wireless_pc_ratio,
    wireless_pc_ratio_reset,
)

__all__ = [
    "D1_KEYS",
    "changed_payments",
    "cumulative_turnover",
    "device_minute_turnover",
    "distinct_payments",
    "first_orders",
    "for_platform",
    "island_totals",
    "match_arrived",
    "match_by_set",
    "match_payments",
    "minutes_seen",
    "minutes_seen_approx",
    "pending_payments",
    "platform_minute_turnover",
    "positive_payments",
    "previous_value",
    "reconcile_order_payments",
    "rejected_payments",
    "running_aggregate",
    "wireless_pc_ratio",
    "wireless_pc_ratio_reset",
]
