"""Scalar column functions."""

from tallyflow.functions.codes import (
    device_label,
    pay_source_label,
    payment_fingerprint,
    platform_name,
    result_key,
)
from tallyflow.functions.money import (
    exact_add,
    exact_div,
    exact_mul,
    exact_round,
    exact_sub,
    from_cents,
    to_cents,
)
from tallyflow.functions.time import (
    epoch_millis_ntz,
    event_time,
    minute_epoch_seconds,
    minute_index,
    minute_start,
)

__all__ = [
    "device_label",
    "epoch_millis_ntz",
    "event_time",
    "exact_add",
    "exact_div",
    "exact_mul",
    "exact_round",
    "exact_sub",
    "from_cents",
    "minute_epoch_seconds",
    "minute_index",
    "minute_start",
    "pay_source_label",
    "payment_fingerprint",
    "platform_name",
    "result_key",
    "to_cents",
]
