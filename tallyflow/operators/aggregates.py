"""Aggregations: platform turnover (A1, A3), device turnover (A2) and the
minute count (A4). All are hash aggregates with a map-side partial step:
what crosses the shuffle is one partial row per key per map task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.constants import DEVICE_PC, EXPECTED_MINUTES
from tallyflow.functions.money import from_cents


def platform_minute_turnover(matched: DataFrame, cents_col: str = "amount_cents") -> DataFrame:
    """A1 (and A3 when the input is not deduplicated): cents per platform and
    minute, plus the published money value."""
    return (
        matched.groupBy("platform", "minute")
        .agg(F.sum(cents_col).alias("turnover_cents"))
        .withColumn("turnover", from_cents("turnover_cents"))
    )


def device_minute_turnover(payments: DataFrame, device_col: str = "pay_platform") -> DataFrame:
    """A2: PC and wireless cents per minute (any non-zero device is wireless)."""
    is_pc = F.col(device_col) == DEVICE_PC
    cents = F.col("amount_cents")
    return payments.groupBy("minute").agg(
        F.sum(F.when(is_pc, cents).otherwise(F.lit(0))).cast("long").alias("pc_cents"),
        F.sum(F.when(~is_pc, cents).otherwise(F.lit(0))).cast("long").alias("wl_cents"),
    )


def minutes_seen(payments: DataFrame, expected: int = EXPECTED_MINUTES) -> DataFrame:
    """A4: number of distinct minutes, and whether the expected count is met.

    Exact ``count(DISTINCT)``; on an unbounded stream use
    ``approx_count_distinct`` instead.
    """
    return payments.agg(F.countDistinct("minute").alias("minutes")).select(
        "minutes",
        F.lit(expected).alias("expected"),
        (F.col("minutes") >= F.lit(expected)).alias("complete"),
    )


def minutes_seen_approx(payments: DataFrame, expected: int = EXPECTED_MINUTES, rsd: float = 0.01) -> DataFrame:
    """A4 on an unbounded stream: HyperLogLog estimate of the distinct
    minutes (bounded state, complete or update mode)."""
    return payments.agg(F.approx_count_distinct("minute", rsd).alias("minutes")).select(
        "minutes",
        F.lit(expected).alias("expected"),
        (F.col("minutes") >= F.lit(expected)).alias("complete"),
    )
