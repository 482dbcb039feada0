"""Registered streaming queries.

Each query replays a feed derived by Spark from the driver's tables in slices
of arrival order, several files each, runs the streaming plan to completion
with an ``availableNow`` trigger (one slice per micro-batch), and returns the table
the stream wrote. Checkpoints, feeds and outputs live in fresh folders under
the shared checkpoint directory, so a lost executor or a restarted driver
resumes from the checkpoint and replays batches idempotently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.operators.matching import first_orders
from tallyflow.operators.skew import hot_keys, hot_table
from tallyflow.session import materialize, shared_path
from tallyflow.sinks.metrics_store import MetricsTable
from tallyflow.sources.tables import orders_ev, orders_v, payments_li, payments_v, redelivered, redelivered_soon
from tallyflow.streaming.feeds import FILES_PER_SLICE, read_feed, write_feed
from tallyflow.streaming.live import LiveMetrics
from tallyflow.streaming.live_match import arrived_match, end_marker, live_match, messages
from tallyflow.streaming.matching import match_payments_stream
from tallyflow.streaming.reset_ratio import ResetRatioStream
from tallyflow.streaming.state import changed_payments_stream
from tallyflow.streaming.turnover import (
    ArrivalOrderRatio,
    start_closed_minutes,
    start_platform_turnover_upserts,
    start_turnover_upsert,
    turnover_stream,
)


def _feed(spark: SparkSession, name: str, *parts: DataFrame) -> DataFrame:
    """The parts, one after the other, as a stream of their slices."""
    path = shared_path(spark, "feeds", name, unique=True)
    for part in parts:
        write_feed(part, path)
    return read_feed(spark, path, parts[0].schema, FILES_PER_SLICE)


def _replay(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    return _feed(spark, name, df)


def _known_first_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The stream-static join's order side (J2 over the whole order table),
    computed once per stream start instead of once per micro-batch."""
    return materialize(first_orders(orders_ev(spark, sf)).select("order_id", "platform"))


def _start_parquet_sink(df: DataFrame, path: str, checkpoint: str):
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _turnover_upsert(spark: SparkSession, sf: str, name: str, feed: DataFrame) -> DataFrame:
    stream = _replay(spark, name, feed)
    table = MetricsTable(spark, shared_path(spark, name, "table", unique=True))
    turnover = turnover_stream(stream, _known_first_orders(spark, sf))
    query = start_turnover_upsert(turnover, table, shared_path(spark, name, "checkpoint", unique=True))
    _run(query)
    return table.read()


def q_stream_turnover(spark, sf):
    """T1, T2, T4, T5 + K1: turnover metrics published in update mode."""
    return _turnover_upsert(spark, sf, "stream_turnover", payments_v(spark, sf))


def q_stream_upsert(spark, sf):
    """K1 replay: every payment is delivered twice, the copy right after the
    original (so that D1 sees it, not only the watermark), through one
    turnover query per platform (each with its own watermark, as the
    reference had one counter per platform); the published tables must equal
    the batch metrics."""
    name = "stream_upsert"
    stream = _replay(spark, name, redelivered_soon(payments_v(spark, sf)))
    tables = {p: MetricsTable(spark, shared_path(spark, name, f"table_{p}", unique=True)) for p in (0, 1)}
    started = start_platform_turnover_upserts(
        stream, _known_first_orders(spark, sf), tables, shared_path(spark, name, "checkpoint", unique=True)
    )
    for query in started:
        _run(query)
    return tables[0].read().unionByName(tables[1].read())


def q_stream_closed_minutes(spark, sf):
    """Append mode publishes a minute only once the watermark closes it;
    the newest minutes stay unpublished (rows-only check)."""
    stream = _replay(spark, "stream_closed_minutes", payments_v(spark, sf))
    out = shared_path(spark, "stream_closed_minutes", "table", unique=True)
    turnover = turnover_stream(stream, _known_first_orders(spark, sf))
    checkpoint = shared_path(spark, "stream_closed_minutes", "checkpoint", unique=True)
    query = start_closed_minutes(turnover, out, checkpoint)
    _run(query)
    return spark.read.schema(turnover.schema).parquet(out)


def q_stream_ratio(spark, sf):
    """Ratio in arrival order; equals W2 when the feed is in order."""
    stream = _replay(spark, "stream_ratio", payments_v(spark, sf))
    ratio = ArrivalOrderRatio(spark, shared_path(spark, "stream_ratio", "table", unique=True))
    query = ratio.start(stream, shared_path(spark, "stream_ratio", "checkpoint", unique=True))
    _run(query)
    return ratio.table.read()


def q_stream_changed_payments(spark, sf):
    """D2 with per-order state; equals the batch D2 on the same feed."""
    stream = _replay(spark, "stream_changed_payments", redelivered(payments_v(spark, sf)))
    out = shared_path(spark, "stream_changed_payments", "table", unique=True)
    changed = changed_payments_stream(stream)
    checkpoint = shared_path(spark, "stream_changed_payments", "checkpoint", unique=True)
    query = _start_parquet_sink(changed, out, checkpoint)
    _run(query)
    return spark.read.schema(changed.schema).parquet(out)


def q_stream_matched_payments(spark, sf):
    """J1 + J2 on two streams (append mode); equals the batch J1."""
    pays = _replay(spark, "stream_matched_payments_pay", payments_v(spark, sf))
    orders = _replay(spark, "stream_matched_payments_orders", orders_ev(spark, sf))
    matched = match_payments_stream(pays, orders).select(
        "arrival", "order_id", "amount_cents", "pay_source", "pay_platform", "minute", "platform"
    )
    out = shared_path(spark, "stream_matched_payments", "table", unique=True)
    checkpoint = shared_path(spark, "stream_matched_payments", "checkpoint", unique=True)
    query = _start_parquet_sink(matched, out, checkpoint)
    _run(query)
    return spark.read.schema(matched.schema).parquet(out)


def _appended(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    out = shared_path(spark, name, "table", unique=True)
    _run(_start_parquet_sink(rows, out, shared_path(spark, name, "checkpoint", unique=True)))
    return spark.read.schema(rows.schema).parquet(out)


def q_stream_live_matched(spark, sf):
    """J1 + J2 in one keyed state, orders and payments on one feed in arrival
    order; equals the batch J1."""
    name, feed = "stream_live_matched", messages(payments_v(spark, sf), orders_ev(spark, sf))
    hot = hot_table(hot_keys(feed, "order_id"))
    return _appended(spark, name, live_match(_replay(spark, name, feed), hot=hot))


#: Minutes that a payment waits for its order in ``stream_pending_payments``:
#: longer than the tables' whole span of days, so every order counts.
PENDING_HORIZON = 20 * 366 * 24 * 60


def q_stream_pending_payments(spark, sf):
    """Payments given up by their timers, after the end marker has moved
    the watermark past the last one's horizon; equals the batch J3."""
    name = "stream_pending_payments"
    at = F.col("create_time_ms")
    known = orders_v(spark, sf).where(F.col("order_status") != "P").withColumn("arrival", at)
    feed = messages(payments_li(spark, sf).withColumn("arrival", at), known)
    hot = hot_table(hot_keys(feed, "order_id"))
    stream = _feed(spark, name, feed, end_marker(feed, PENDING_HORIZON))
    out = _appended(spark, name, live_match(stream, PENDING_HORIZON, unmatched=True, hot=hot))
    return out.where("platform is null").select("order_id", "amount_cents", "pay_source", "pay_platform", "minute")


def q_stream_arrived_matched(spark, sf):
    """J5 in arrival order; equals the batch J5."""
    name, feed = "stream_arrived_matched", messages(payments_v(spark, sf), orders_ev(spark, sf))
    hot = hot_table(hot_keys(feed, "order_id"))
    out = _appended(spark, name, arrived_match(_replay(spark, name, feed), hot=hot))
    return out.select("arrival", "order_id", "amount_cents", "platform")


def q_stream_metrics(spark, sf):
    """The whole live flow: payment and order streams -> M1, M2, M3."""
    pays = _replay(spark, "stream_metrics_pay", payments_v(spark, sf))
    orders = _replay(spark, "stream_metrics_orders", orders_ev(spark, sf))
    live = LiveMetrics(spark, shared_path(spark, "stream_metrics", "table", unique=True))
    started = live.start(pays, orders, shared_path(spark, "stream_metrics", "checkpoint", unique=True))
    for query in started:
        _run(query)
    return live.metrics()


def q_stream_ratio_reset(spark, sf):
    """W3 on a stream; equals the batch W3 when the feed is in order."""
    stream = _replay(spark, "stream_ratio_reset", payments_v(spark, sf))
    ratio = ResetRatioStream(spark, shared_path(spark, "stream_ratio_reset", "table", unique=True))
    query = ratio.start(stream, shared_path(spark, "stream_ratio_reset", "checkpoint", unique=True))
    _run(query)
    return ratio.table.read()


def q_stream_late(spark, sf):
    """After the whole feed, another payment of one cent more arrives for
    every payment. Those of the newest minute - 5 and later count, the older
    ones are dropped."""
    name = "stream_late"
    pays = payments_v(spark, sf)
    late = pays.withColumn("pay_amount", F.col("pay_amount") + F.lit(0.01))
    stream = _feed(spark, name, pays, late)
    table = MetricsTable(spark, shared_path(spark, name, "table", unique=True))
    turnover = turnover_stream(stream, _known_first_orders(spark, sf))
    _run(start_turnover_upsert(turnover, table, shared_path(spark, name, "checkpoint", unique=True)))
    return table.read()


def _snapshot(spark, sf, name: str, mode: str):
    stream = _replay(spark, name, payments_v(spark, sf))
    table = MetricsTable(spark, shared_path(spark, name, "table", unique=True))
    turnover = turnover_stream(stream, _known_first_orders(spark, sf))
    query = start_turnover_upsert(
        turnover, table, shared_path(spark, name, "checkpoint", unique=True), {"processingTime": "1 second"}, output_mode=mode
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return table.read()


def q_stream_snapshot_full(spark, sf):
    """Every minute republished at each tick of a timed trigger."""
    return _snapshot(spark, sf, "stream_snapshot_full", "complete")


def q_stream_snapshot_changed(spark, sf):
    """The changed minutes published at each tick of a timed trigger."""
    return _snapshot(spark, sf, "stream_snapshot_changed", "update")


STREAM_QUERIES = {
    "stream_ratio_reset": q_stream_ratio_reset,
    "stream_metrics": q_stream_metrics,
    "stream_matched_payments": q_stream_matched_payments,
    "stream_live_matched": q_stream_live_matched,
    "stream_pending_payments": q_stream_pending_payments,
    "stream_arrived_matched": q_stream_arrived_matched,
    "stream_turnover": q_stream_turnover,
    "stream_upsert": q_stream_upsert,
    "stream_closed_minutes": q_stream_closed_minutes,
    "stream_ratio": q_stream_ratio,
    "stream_changed_payments": q_stream_changed_payments,
    "stream_late": q_stream_late,
    "stream_snapshot_full": q_stream_snapshot_full,
    "stream_snapshot_changed": q_stream_snapshot_changed,
}
