"""Order and payment views over the driver's parquet tables.

Two families:

* ``orders_v`` / ``payments_li`` come from ``orders`` / ``lineitem``: large,
  day resolution, every payment has an order. Used for joins and the bench.
* ``orders_ev`` / ``payments_v`` come from ``events``: minute resolution, an
  ``arrival`` column (``event_id``, monotone in time), repeated orders for one
  id on both platforms and payments that precede their order.

Each view selects only the columns it needs, so the parquet scan reads only
those (``ReadSchema``) and filters reach the scan (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.functions.time import epoch_millis_ntz

# Offset added to ``arrival`` of a redelivered message: larger than any id.
REDELIVERY_OFFSET = 1 << 40


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("buyer"), F.col("o_custkey").cast("string")).alias("buyer_id"),
        epoch_millis_ntz("o_orderdate").alias("create_time_ms"),
        F.col("o_totalprice").alias("total_price"),
        (F.col("o_orderkey") % 2).cast("int").alias("platform"),
        F.col("o_orderstatus").alias("order_status"),
    )


def payments_li(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").alias("pay_amount"),
        (F.col("l_linenumber") % 4).cast("int").alias("pay_source"),
        F.when(F.col("l_linestatus") == "F", F.lit(0)).otherwise(F.lit(1)).alias("pay_platform"),
        epoch_millis_ntz("l_shipdate").alias("create_time_ms"),
    )


def orders_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.where(F.col("event_type") == "signup").select(
        F.col("event_id").alias("arrival"),
        F.col("user_id").alias("order_id"),
        epoch_millis_ntz("ts").alias("create_time_ms"),
        (F.col("event_id") % 2).cast("int").alias("platform"),
    )


def payments_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    source = (
        F.when(F.col("event_type") == "click", F.lit(0))
        .when(F.col("event_type") == "view", F.lit(1))
        .when(F.col("event_type") == "purchase", F.lit(2))
        .otherwise(F.lit(3))
    )
    return ev.where(F.col("event_type") != "signup").select(
        F.col("event_id").alias("arrival"),
        F.col("user_id").alias("order_id"),
        F.col("value").alias("pay_amount"),
        source.alias("pay_source"),
        ((F.col("event_id") % 3) % 2).cast("int").alias("pay_platform"),
        epoch_millis_ntz("ts").alias("create_time_ms"),
    )


def redelivered(payments: DataFrame, arrival_col: str = "arrival") -> DataFrame:
    """The whole feed delivered twice, the copy after the original (an
    at-least-once redelivery after a restart). Exercises every dedup path
    on every row."""
    again = payments.withColumn(arrival_col, F.col(arrival_col) + F.lit(REDELIVERY_OFFSET))
    return payments.unionByName(again)


def redelivered_soon(payments: DataFrame, arrival_col: str = "arrival") -> DataFrame:
    """Every payment delivered twice, the copy right after the original."""
    at = F.col(arrival_col) * F.lit(2)
    return payments.withColumn(arrival_col, at).unionByName(payments.withColumn(arrival_col, at + F.lit(1)))
