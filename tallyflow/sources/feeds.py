"""Message feeds: payment source (S1), order source (S2), topic routing (S3),
end markers (S4) and bounded ingest (S6).

In production the feeds are Kafka topics (``readStream.format("kafka")`` with
``startingOffsets=earliest``); here every function takes a DataFrame so the
same code serves parquet batch reads, file streams and Kafka alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyflow.constants import END_MARKER, PLATFORM_TAOBAO, PLATFORM_TMALL
from tallyflow.functions.money import to_cents
from tallyflow.functions.time import minute_index

PAY_TOPIC = "pay"
TAOBAO_TOPIC = "taobao_orders"
TMALL_TOPIC = "tmall_orders"


def payments_source(payments: DataFrame, cents_mode: str = "exact") -> DataFrame:
    """Decode payments to the normalised form (cents, minute).

    Keeps every input column and adds ``amount_cents`` and ``minute``.
    """
    return payments.withColumn("amount_cents", to_cents("pay_amount", cents_mode)).withColumn(
        "minute", minute_index("create_time_ms")
    )


def orders_source(taobao: DataFrame, tmall: DataFrame) -> DataFrame:
    """Tag each order feed with its platform (the topic is the platform)
    and union them."""
    return taobao.withColumn("platform", F.lit(PLATFORM_TAOBAO)).unionByName(
        tmall.withColumn("platform", F.lit(PLATFORM_TMALL))
    )


def route_by_topic(feed: DataFrame, topic_col: str = "topic") -> dict[str, DataFrame]:
    """S3: split a mixed feed into its payment and two order topics.

    Three filters over one lazily-evaluated frame; cache the feed first if it
    is expensive to produce and all three branches are consumed.
    """
    t = F.col(topic_col)
    return {
        PAY_TOPIC: feed.where(t == PAY_TOPIC),
        TAOBAO_TOPIC: feed.where(t == TAOBAO_TOPIC),
        TMALL_TOPIC: feed.where(t == TMALL_TOPIC),
    }


def route_to_folders(feed: DataFrame, path: str, topic_col: str = "topic") -> str:
    """S3 in one pass: write the mixed feed once, one folder per topic
    (``<path>/<topic_col>=<topic>``). A consumer reading one topic back with
    ``read_route`` prunes the other folders instead of re-scanning the feed."""
    feed.write.mode("overwrite").partitionBy(topic_col).parquet(path)
    return path


def read_route(spark, path: str, topic: str, topic_col: str = "topic") -> DataFrame:
    """One topic of a routed feed (partition pruning on ``topic_col``)."""
    return spark.read.parquet(path).where(F.col(topic_col) == F.lit(topic))


def is_end_marker(body_col: str = "body"):
    return F.col(body_col) == F.lit(END_MARKER)


def drop_end_markers(messages: DataFrame, body_col: str = "body") -> DataFrame:
    """Skip the two-byte end-of-feed marker on any topic."""
    return messages.where(~is_end_marker(body_col) | F.col(body_col).isNull())


def feed_completion(messages: DataFrame, topic_col: str = "topic", body_col: str = "body") -> DataFrame:
    """Per topic, whether its end marker has been seen."""
    return messages.groupBy(topic_col).agg(
        F.max(is_end_marker(body_col).cast("int")).cast("boolean").alias("complete")
    )


def bounded_ingest_options(max_files: int | None = None, max_offsets: int | None = None) -> dict:
    """Bound each micro-batch like the reference's pull batch of 100.

    ``maxFilesPerTrigger`` for file sources, ``maxOffsetsPerTrigger`` for Kafka.
    """
    opts: dict[str, str] = {}
    if max_files is not None:
        opts["maxFilesPerTrigger"] = str(max_files)
    if max_offsets is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts
