"""Matching payments to orders (all equi-joins on ``order_id``).

Scale notes:

* Every order side is first reduced to at most one row per id (J2, J4) or
  per (id, platform) (J5) with a hash aggregate. Its partial step runs
  before the shuffle, so a hot order id costs one row per map task, and the
  join's build side is bounded by the number of distinct ids.
* The payment side is never broadcast; the join is a shuffle join on
  ``order_id`` that AQE may turn into a broadcast join after measuring the
  order side. Because the order side reaches the join through an
  aggregate, AQE cannot split a hot id; the row-level joins here salt hot
  ids explicitly (``operators.skew``). ``rows_per_task=None`` turns that
  off and gives the plain join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.operators.skew import AUTO, salted_join


def _join(payments: DataFrame, orders: DataFrame, how: str, rows_per_task: int | None) -> DataFrame:
    if rows_per_task is None:
        return payments.join(orders, "order_id", how)
    return salted_join(payments, orders, "order_id", how, rows_per_task=rows_per_task)


def first_orders(orders: DataFrame, arrival_col: str = "arrival", keep: tuple[str, ...] = ("platform",)) -> DataFrame:
    """The first order to arrive for each id wins; later ones are ignored.

    Returns ``order_id``, the kept columns of the first order and its
    ``first_arrival``.
    """
    aggs = [F.min_by(c, arrival_col).alias(c) for c in keep]
    return orders.groupBy("order_id").agg(*aggs, F.min(arrival_col).alias("first_arrival"))


def match_payments(
    payments: DataFrame,
    orders: DataFrame,
    arrival_col: str = "arrival",
    first: bool = True,
    rows_per_task: int | None = AUTO,
) -> DataFrame:
    """Every payment whose order exists, tagged with that order's platform.

    With ``first=True`` (the default, as the live path does) repeated orders
    are reduced by J2 first, so they cannot fan payments out.
    """
    o = first_orders(orders, arrival_col).select("order_id", "platform") if first else orders.select(
        "order_id", "platform"
    )
    return _join(payments, o, "inner", rows_per_task)


def pending_payments(
    payments: DataFrame, orders: DataFrame, rows_per_task: int | None = AUTO
) -> DataFrame:
    """Payments whose order has not arrived (the join's waiting buffer)."""
    ids = orders.select("order_id").distinct()
    return _join(payments, ids, "left_anti", rows_per_task)


def match_by_set(
    payments: DataFrame, orders: DataFrame, rows_per_task: int | None = AUTO
) -> DataFrame:
    """Match against the two id sets; Taobao (0) is tested first, so an
    id present on both platforms counts as Taobao."""
    o = orders.groupBy("order_id").agg(F.min("platform").alias("platform"))
    return _join(payments, o, "inner", rows_per_task)


def match_arrived(
    payments: DataFrame,
    orders: DataFrame,
    arrival_col: str = "arrival",
    rows_per_task: int | None = AUTO,
) -> DataFrame:
    """Per platform, keep a payment only if an order with its id had
    already arrived on that platform. An id on both platforms can match on
    both. Late orders never release earlier payments."""
    seen = orders.groupBy("order_id", "platform").agg(F.min(arrival_col).alias("_seen"))
    return _join(payments, seen, "inner", rows_per_task).where(F.col(arrival_col) > F.col("_seen")).drop("_seen")
