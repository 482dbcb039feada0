"""Message topics: the production form of S1, S2 and S4.

Each topic carries one message per order or payment; the body is JSON here
(the reference used a binary codec, replaced by typed columns). The end of
a feed is a two-byte ``00 00`` body on every topic.

``topic_messages`` reads topics with Spark's Kafka source (the
``spark-sql-kafka`` package must be on the classpath; it is not bundled
with PySpark). ``decode_*`` work on any frame with ``topic`` and a binary
``value`` column, batch or streaming, so they are tested without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tallyflow.constants import PLATFORM_TAOBAO, PLATFORM_TMALL
from tallyflow.sources.feeds import drop_end_markers

PAYMENT_BODY = StructType(
    [
        StructField("orderId", LongType()),
        StructField("payAmount", DoubleType()),
        StructField("paySource", IntegerType()),
        StructField("payPlatform", IntegerType()),
        StructField("createTime", LongType()),
    ]
)
ORDER_BODY = StructType(
    [
        StructField("orderId", LongType()),
        StructField("buyerId", StringType()),
        StructField("productId", StringType()),
        StructField("salerId", StringType()),
        StructField("createTime", LongType()),
        StructField("totalPrice", DoubleType()),
    ]
)


def topic_messages(
    spark: SparkSession,
    servers: str,
    topics: list[str],
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Stream ``topic, value, partition, offset`` from the earliest offset
    (S1/S2 sources, S6 bound per micro-batch)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load().select("topic", "value", "partition", "offset")


def _decoded(messages: DataFrame, schema: StructType) -> DataFrame:
    body = drop_end_markers(messages, "value")
    return body.select("*", F.from_json(F.col("value").cast("string"), schema).alias("m"))


def decode_payments(messages: DataFrame) -> DataFrame:
    """S1 + S4: payment messages -> the payment columns the operators take."""
    return _decoded(messages, PAYMENT_BODY).select(
        F.col("m.orderId").alias("order_id"),
        F.col("m.payAmount").alias("pay_amount"),
        F.col("m.paySource").alias("pay_source"),
        F.col("m.payPlatform").alias("pay_platform"),
        F.col("m.createTime").alias("create_time_ms"),
        *[c for c in ("partition", "offset") if c in messages.columns],
    )


def decode_orders(messages: DataFrame, taobao_topic: str, tmall_topic: str) -> DataFrame:
    """S2 + S4: order messages of both topics, tagged with the platform of
    their topic."""
    platform = F.when(F.col("topic") == taobao_topic, F.lit(PLATFORM_TAOBAO)).when(
        F.col("topic") == tmall_topic, F.lit(PLATFORM_TMALL)
    )
    return (
        _decoded(messages.where(F.col("topic").isin(taobao_topic, tmall_topic)), ORDER_BODY)
        .select(
            F.col("m.orderId").alias("order_id"),
            F.col("m.buyerId").alias("buyer_id"),
            F.col("m.createTime").alias("create_time_ms"),
            F.col("m.totalPrice").alias("total_price"),
            platform.alias("platform"),
            *[c for c in ("partition", "offset") if c in messages.columns],
        )
    )
