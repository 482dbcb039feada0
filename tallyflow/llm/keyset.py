"""A set of 64-bit keys in bounded memory: one bit per residue.

``bitmap`` answers "may be in the set" and is never wrong when it says no, so
that what it rejects can be left out before a shuffle without changing a
result. It has 2**BITS bits whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 27


def bitmap(keys: DataFrame, column: str = "key") -> np.ndarray:
    """The bits of ``keys``' ``column`` (long): 2**BITS / 8 bytes."""
    slot = F.col(column).bitwiseAND(F.lit((1 << BITS) - 1)) + F.lit(1)
    parts = (
        keys.select(slot.alias("slot"))
        .groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
        .collect()  # at most 2**BITS / 32768 rows of 4 KB
    )
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for bucket, bits in parts:
        at = (bucket - 1) * 4096
        out[at : at + 4096] = np.frombuffer(bits, np.uint8)
    return out


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys & np.uint64((1 << BITS) - 1)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
