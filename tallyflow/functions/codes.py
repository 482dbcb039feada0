"""Keys and codes: result key (F5), platform name (F6), code labels (F7),
payment fingerprint (F9)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyflow.constants import (
    DEVICE_LABELS,
    FINGERPRINT_PLATFORM_SHIFT,
    FINGERPRINT_SOURCE_SHIFT,
    PAY_SOURCE_LABELS,
    PLATFORM_NAMES,
    PLATFORM_TAOBAO,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def result_key(prefix: str, team: str, seconds: Column | str) -> Column:
    """``<prefix><team>_<epoch seconds>``."""
    return F.concat(F.lit(f"{prefix}{team}_"), _c(seconds).cast("string"))


def platform_name(order_type: Column | str) -> Column:
    """order type 0 -> 'taobao', anything else -> 'tmall'."""
    return F.when(_c(order_type) == PLATFORM_TAOBAO, F.lit(PLATFORM_NAMES[0])).otherwise(
        F.lit(PLATFORM_NAMES[1])
    )


def _label(mapping: dict[int, str], code: Column) -> Column:
    # A literal map is a constant of the expression: evaluated in codegen,
    # no join and no broadcast needed for a four-entry domain.
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return lookup[code]


def pay_source_label(code: Column | str) -> Column:
    """0 alipay, 1 voucher, 2 unionpay, 3 other (unknown -> null)."""
    return _label(PAY_SOURCE_LABELS, _c(code))


def device_label(code: Column | str) -> Column:
    """0 pc, anything else wireless (as the live ratio path treats it)."""
    return F.when(_c(code) == 0, F.lit(DEVICE_LABELS[0])).otherwise(F.lit(DEVICE_LABELS[1]))


def payment_fingerprint(
    cents: Column | str, source: Column | str, platform: Column | str, minute: Column | str
) -> Column:
    """``cents | source << 10 | platform << 11 | minute`` (collides by design)."""
    return (
        _c(cents)
        .cast("long")
        .bitwiseOR(F.shiftleft(_c(source).cast("long"), FINGERPRINT_SOURCE_SHIFT))
        .bitwiseOR(F.shiftleft(_c(platform).cast("long"), FINGERPRINT_PLATFORM_SHIFT))
        .bitwiseOR(_c(minute).cast("long"))
    )
