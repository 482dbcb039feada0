"""Deduplication: exact distinct over the normalised payment (D1) and
"changed since the previous payment of the order" (D2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.codes import payment_fingerprint
from tallyflow.operators.skew import AUTO, hot_keys, hot_table
from tallyflow.operators.windows import previous_value

# D1 equality: all five normalised fields, after cents and minute conversion.
D1_KEYS = ["order_id", "amount_cents", "pay_source", "pay_platform", "minute"]


def distinct_payments(payments: DataFrame, keys: list[str] | None = None, first_by: str | None = None) -> DataFrame:
    """Two payments equal on the five normalised fields collapse to one.

    Without ``first_by`` the result has exactly the key columns (a distinct).
    With ``first_by`` (e.g. ``arrival``) the earliest value of that column
    is kept too. Both are hash aggregates with a map-side partial step, and
    the shuffle is keyed on all five fields, so one hot order id spreads.
    """
    keys = keys or D1_KEYS
    if first_by is None:
        return payments.select(*keys).dropDuplicates(keys)
    return payments.groupBy(*keys).agg(F.min(first_by).alias(first_by))


def changed_payments(
    payments: DataFrame, arrival_col: str = "arrival", block: int = 1 << 16, rows_per_task: int | None = AUTO
) -> DataFrame:
    """Drop a payment only if its fingerprint equals the fingerprint of
    the previous payment of the same order (A, B, A keeps all three).

    Input: normalised payments with ``arrival``. Output: ``arrival, order_id,
    minute, amount_cents, pay_platform, fingerprint``. Payments of one
    arrival go by fingerprint; those with a null id are an order of their own.

    One window by order id, one shuffle. Ids estimated to hold more than
    ``rows_per_task`` rows (see ``operators.skew``) are cut into blocks of
    arrivals instead; ``rows_per_task=None`` takes every id that way.
    """
    fp = payment_fingerprint("amount_cents", "pay_source", "pay_platform", "minute")
    d = payments.select(arrival_col, "order_id", "minute", "amount_cents", "pay_platform", fp.alias("fingerprint"))
    order = Window.partitionBy("order_id").orderBy(arrival_col, "fingerprint")

    def blocked(rows: DataFrame) -> DataFrame:
        return previous_value(rows, ["order_id"], arrival_col, "fingerprint", "_prev_fp", block=block)

    def whole(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_prev_fp", F.lag("fingerprint").over(order))

    if rows_per_task is None:
        with_prev = blocked(d)
    elif (table := hot_table(hot_keys(d, "order_id", rows_per_task))) is None:
        with_prev = whole(d)
    else:
        table = table.withColumnRenamed("order_id", "_hot_id")
        flagged = d.join(table, d["order_id"].eqNullSafe(F.col("_hot_id")), "left")
        few = whole(flagged.where("_salts is null").select(*d.columns))
        with_prev = few.unionByName(blocked(flagged.where("_salts is not null").select(*d.columns)))
    return with_prev.where(
        F.col("_prev_fp").isNull() | (F.col("_prev_fp") != F.col("fingerprint"))
    ).drop("_prev_fp")
