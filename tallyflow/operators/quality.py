"""Data-quality operators: platform split (P1), payment sign rule (P2) and
order reconciliation (P3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.functions.money import to_cents


def for_platform(matched: DataFrame, platform: int, platform_col: str = "platform") -> DataFrame:
    """The matched payments of one platform. Aggregations keep
    ``platform`` as a group key instead of branching."""
    return matched.where(F.col(platform_col) == F.lit(platform))


def payment_status(amount_col: str = "pay_amount"):
    a = F.col(amount_col)
    return F.when(a > 0, F.lit("accepted")).when(a == 0, F.lit("zero")).when(
        a < 0, F.lit("negative")
    ).otherwise(F.lit("missing"))


def positive_payments(payments: DataFrame, amount_col: str = "pay_amount") -> DataFrame:
    """Keep payments with a positive amount (zero ones are dropped)."""
    return payments.where(F.col(amount_col) > 0)


def rejected_payments(payments: DataFrame, amount_col: str = "pay_amount") -> DataFrame:
    """The negative (or missing) payments, with the reason, for a rejects table."""
    return payments.where(~(F.col(amount_col) >= 0) | F.col(amount_col).isNull()).withColumn(
        "reason", payment_status(amount_col)
    )


def reconcile_order_payments(
    orders: DataFrame,
    payments: DataFrame,
    cents_mode: str = "exact",
    total_col: str = "total_price",
    amount_col: str = "pay_amount",
    arrival_col: str | None = None,
) -> DataFrame:
    """Orders whose payments do not add up to the order total.

    Payments are summed per order first (map-side partial aggregation), so
    the join sees one row per paid order however skewed the payment keys.
    Orders without any payment are reported with ``paid_cents = 0``. Orders
    must be one row per id, or give ``arrival_col`` to keep the first order
    of each id (J2).
    """
    if arrival_col is not None:
        orders = orders.groupBy("order_id").agg(F.min_by(total_col, arrival_col).alias(total_col))
    paid = payments.groupBy("order_id").agg(
        F.sum(to_cents(amount_col, cents_mode)).alias("paid_cents"),
        F.count(F.lit(1)).alias("n_payments"),
    )
    totals = orders.select("order_id", to_cents(total_col, cents_mode).alias("total_cents"))
    joined = totals.join(paid, "order_id", "left").select(
        "order_id",
        "total_cents",
        F.coalesce("paid_cents", F.lit(0)).cast("long").alias("paid_cents"),
        F.coalesce("n_payments", F.lit(0)).cast("long").alias("n_payments"),
    )
    return joined.withColumn("diff_cents", F.col("total_cents") - F.col("paid_cents")).where(
        F.col("diff_cents") != 0
    )
