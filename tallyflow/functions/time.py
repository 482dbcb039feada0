"""Event time: epoch milliseconds, minute index (F2) and minute seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyflow.constants import MILLIS_PER_MINUTE, SECONDS_PER_MINUTE

_EPOCH_NTZ_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_millis_ntz(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a zone-less timestamp.

    Independent of the session time zone (a cast to TIMESTAMP would shift it).
    """
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ_SQL), _c(ts))


def minute_index(ms: Column | str) -> Column:
    """epoch milliseconds -> minute number (floor; the same as integer
    division for every time after 1970)."""
    return F.floor(_c(ms) / F.lit(MILLIS_PER_MINUTE)).cast("long")


def minute_epoch_seconds(minute: Column | str) -> Column:
    """minute number -> epoch second of its second 0."""
    return _c(minute) * F.lit(SECONDS_PER_MINUTE)


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds -> TIMESTAMP, usable as a watermark column."""
    return F.timestamp_millis(_c(ms))


def minute_start(ms: Column | str) -> Column:
    """TIMESTAMP of the start of the event's minute (a tumbling bucket)."""
    return F.timestamp_seconds(minute_epoch_seconds(minute_index(ms)))
