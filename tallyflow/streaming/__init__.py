"""Structured Streaming: tumbling minutes, lateness, emit modes, the
arrival-order ratio, changed-payment state, stream-stream matching, the
whole live flow and the replay feeds used to test them."""

from tallyflow.streaming.feeds import read_feed, write_feed
from tallyflow.streaming.live import LiveMetrics
from tallyflow.streaming.matching import match_payments_stream
from tallyflow.streaming.reset_ratio import ResetRatioStream
from tallyflow.streaming.state import changed_payments_stream
from tallyflow.streaming.turnover import (
    ArrivalOrderRatio,
    start_closed_minutes,
    start_platform_turnover_upserts,
    start_turnover_upsert,
    turnover_metric_rows,
    turnover_stream,
)

__all__ = [
    "ArrivalOrderRatio",
    "LiveMetrics",
    "ResetRatioStream",
    "changed_payments_stream",
    "match_payments_stream",
    "read_feed",
    "start_closed_minutes",
    "start_platform_turnover_upserts",
    "start_turnover_upsert",
    "turnover_metric_rows",
    "turnover_stream",
    "write_feed",
]
