"""Registered queries: one per operator of the survey's inventory.

Each query takes ``(spark, sf_dir)``, reads the driver's tables (whole
tables, no sampling) and returns a DataFrame whose column names equal those
of the matching SQL in ``tallyflow.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.constants import DEFAULT_TEAM, END_MARKER, PLATFORM_TMALL, RATIO_PREFIX
from tallyflow.functions import (
    device_label,
    exact_add,
    exact_div,
    exact_mul,
    exact_round,
    exact_sub,
    minute_epoch_seconds,
    minute_index,
    pay_source_label,
    payment_fingerprint,
    platform_name,
    result_key,
)
from tallyflow.functions.time import epoch_millis_ntz
from tallyflow.operators import (
    changed_payments,
    cumulative_turnover,
    device_minute_turnover,
    distinct_payments,
    first_orders,
    for_platform,
    match_arrived,
    match_by_set,
    match_payments,
    minutes_seen,
    pending_payments,
    positive_payments,
    reconcile_order_payments,
    rejected_payments,
    wireless_pc_ratio_reset,
)
from tallyflow.plans.metrics import platform_turnover, ratio_metric
from tallyflow.session import configure, shared_path
from tallyflow.sinks import lookup_metrics, metrics_rows, remove_metrics
from tallyflow.sources import (
    delimited_file_check,
    drop_end_markers,
    feed_completion,
    orders_ev,
    orders_source,
    orders_v,
    payments_li,
    payments_source,
    payments_v,
    read_delimited_orders,
    read_table,
    redelivered,
    route_by_topic,
    write_delimited_orders,
)
from tallyflow.sources.feeds import PAY_TOPIC, TAOBAO_TOPIC, TMALL_TOPIC

Query = Callable[[SparkSession, str], DataFrame]


def _norm(df: DataFrame, mode: str = "exact") -> DataFrame:
    return payments_source(df, mode)


# --- sources and scalar functions -------------------------------------------------


def q_payments_normalised(spark, sf):
    p = _norm(payments_li(spark, sf))
    return p.select(
        "order_id", "amount_cents", "pay_source", "pay_platform", "minute",
        minute_epoch_seconds("minute").alias("minute_s"),
    )


def q_payments_truncated(spark, sf):
    p = _norm(payments_li(spark, sf), "truncate")
    return p.select("order_id", "amount_cents", "pay_source", "pay_platform", "minute")


def q_decoded_payments(spark, sf):
    p = payments_v(spark, sf)
    return p.select(
        "arrival", "order_id", "pay_source", pay_source_label("pay_source").alias("source_label"),
        "pay_platform", device_label("pay_platform").alias("device_label"),
    )


def _mixed_feed(spark, sf) -> DataFrame:
    """One message feed over ``events``: sign-ups are orders on the topic of
    their platform, everything else is a payment."""
    ev = read_table(spark, sf, "events")
    topic = F.when(
        F.col("event_type") == "signup",
        F.when(F.col("event_id") % 2 == 0, F.lit(TAOBAO_TOPIC)).otherwise(F.lit(TMALL_TOPIC)),
    ).otherwise(F.lit(PAY_TOPIC))
    return ev.select(
        topic.alias("topic"),
        F.col("event_id").alias("arrival"),
        F.col("user_id").alias("order_id"),
        F.col("props"),
    )


def q_topic_routing(spark, sf):
    routes = route_by_topic(_mixed_feed(spark, sf))
    orders = orders_source(
        routes[TAOBAO_TOPIC].select("arrival", "order_id", "topic"),
        routes[TMALL_TOPIC].select("arrival", "order_id", "topic"),
    ).withColumn("platform_name", platform_name("platform"))
    pays = routes[PAY_TOPIC].select(
        "arrival", "order_id", "topic",
        F.lit(None).cast("int").alias("platform"), F.lit(None).cast("string").alias("platform_name"),
    )
    return orders.unionByName(pays)


def q_drop_end_markers(spark, sf):
    feed = _mixed_feed(spark, sf)
    msgs = feed.select("topic", "arrival", F.encode("props", "UTF-8").alias("body"))
    markers = msgs.groupBy("topic").agg((F.max("arrival") + 1).alias("arrival")).withColumn(
        "body", F.lit(END_MARKER)
    )
    all_msgs = msgs.unionByName(markers)
    # One row per topic: a bounded broadcast, so the join never shuffles the
    # messages on a three-valued key.
    done = F.broadcast(feed_completion(all_msgs))
    kept = drop_end_markers(all_msgs)
    return kept.join(done, "topic", "inner").select(
        "topic", "arrival", F.octet_length("body").alias("body_bytes"), "complete"
    )


def q_delimited_orders(spark, sf):
    path = shared_path(spark, "delimited_orders", unique=True)
    write_delimited_orders(orders_ev(spark, sf), path)
    return read_delimited_orders(spark, path).select("arrival", "order_id", "create_time_ms", "platform")


def q_exact_arith(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        exact_add("l_extendedprice", "l_tax").alias("sum_v"),
        exact_sub("l_extendedprice", "l_discount").alias("diff_v"),
        exact_mul("l_extendedprice", "l_discount").alias("prod_v"),
        exact_div("l_extendedprice", "l_quantity").alias("quot_v"),
        exact_round(exact_mul("l_extendedprice", "l_discount"), 2).alias("rounded_v"),
    )


def q_exact_arith_wide(spark, sf):
    """F8 on operands of 1e10 and more, and with 10 decimals."""
    li = read_table(spark, sf, "lineitem")
    big = (F.col("l_extendedprice").cast("decimal(18,2)") * F.lit(1_000_000)).cast("double")
    tiny = (F.col("l_discount").cast("decimal(18,2)") * F.lit(Decimal("0.00000001"))).cast("double")
    return li.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), big.alias("big"), tiny.alias("tiny")
    ).select(
        "order_id", "line",
        exact_add("big", "tiny").alias("sum_v"),
        exact_sub("big", "tiny").alias("diff_v"),
        exact_mul("big", "tiny").alias("prod_v"),
    )


def q_fingerprints(spark, sf):
    p = _norm(payments_v(spark, sf))
    return p.select(
        "arrival", "order_id",
        payment_fingerprint("amount_cents", "pay_source", "pay_platform", "minute").alias("fingerprint"),
    )


# --- quality ----------------------------------------------------------------------


def q_positive_payments(spark, sf):
    return positive_payments(payments_v(spark, sf)).select("arrival", "order_id", "pay_amount")


def q_order_reconciliation(spark, sf):
    return reconcile_order_payments(orders_v(spark, sf), payments_li(spark, sf)).select(
        "order_id", "total_cents", "paid_cents", "n_payments", "diff_cents"
    )


# --- matching ---------------------------------------------------------------------


def q_matched_payments(spark, sf):
    m = match_payments(_norm(payments_v(spark, sf)), orders_ev(spark, sf))
    return m.select("arrival", "order_id", "amount_cents", "pay_source", "pay_platform", "minute", "platform")


def q_platform_payments(spark, sf):
    """The matched payments routed to the Tmall branch."""
    m = for_platform(match_payments(_norm(payments_v(spark, sf)), orders_ev(spark, sf)), PLATFORM_TMALL)
    return m.select("arrival", "order_id", "amount_cents", "platform")


def q_first_orders(spark, sf):
    return first_orders(orders_ev(spark, sf)).select("order_id", "platform", "first_arrival")


def q_pending_payments(spark, sf):
    known = orders_v(spark, sf).where(F.col("order_status") != "P")
    p = pending_payments(_norm(payments_li(spark, sf)), known)
    return p.select("order_id", "amount_cents", "pay_source", "pay_platform", "minute")


def q_set_matched(spark, sf):
    m = match_by_set(_norm(payments_v(spark, sf)), orders_ev(spark, sf))
    return m.select("arrival", "order_id", "amount_cents", "platform")


def q_arrived_matched(spark, sf):
    m = match_arrived(_norm(payments_v(spark, sf)), orders_ev(spark, sf))
    return m.select("arrival", "order_id", "amount_cents", "platform")


# --- dedup ------------------------------------------------------------------------


def q_distinct_payments(spark, sf):
    return distinct_payments(_norm(redelivered(payments_v(spark, sf))))


def q_changed_payments(spark, sf):
    return changed_payments(_norm(redelivered(payments_v(spark, sf))))


def q_rejected_payments(spark, sf):
    """P2's other side: payments below zero after a refund of 20."""
    p = payments_v(spark, sf).withColumn("pay_amount", F.col("pay_amount") - F.lit(20.0))
    return rejected_payments(p).select("arrival", "order_id", "pay_amount", "reason")


def q_delimited_check(spark, sf):
    """Record counts against the headers, over all files of the log."""
    path = shared_path(spark, "delimited_check", unique=True)
    write_delimited_orders(orders_ev(spark, sf), path)
    return delimited_file_check(spark, path).agg(
        F.sum("declared").alias("declared"), F.sum("found").alias("found"), F.bool_and("ok").alias("ok")
    )


# --- aggregates -------------------------------------------------------------------


def q_platform_minute_turnover(spark, sf):
    return platform_turnover(payments_li(spark, sf), orders_v(spark, sf), arrival_col="create_time_ms")


def q_platform_minute_turnover_events(spark, sf):
    return platform_turnover(redelivered(payments_v(spark, sf)), orders_ev(spark, sf))


def q_device_minute_turnover(spark, sf):
    return device_minute_turnover(_norm(payments_v(spark, sf)))


def q_minute_turnover_nodedup(spark, sf):
    return platform_turnover(redelivered(payments_v(spark, sf)), orders_ev(spark, sf), dedup=False)


def q_minutes_seen(spark, sf):
    return minutes_seen(_norm(payments_v(spark, sf)))


# --- windows ----------------------------------------------------------------------


def q_cumulative_turnover(spark, sf):
    return cumulative_turnover(device_minute_turnover(_norm(payments_v(spark, sf)))).select(
        "minute", "pc_cents", "wl_cents", "cum_pc_cents", "cum_wl_cents"
    )


def q_wireless_pc_ratio(spark, sf):
    return ratio_metric(payments_v(spark, sf)).select("minute", "cum_pc_cents", "cum_wl_cents", "ratio")


def q_wireless_pc_ratio_reset(spark, sf):
    return wireless_pc_ratio_reset(_norm(payments_v(spark, sf)))


# --- sinks ------------------------------------------------------------------------


def _metrics(spark, sf) -> DataFrame:
    turnover = platform_turnover(payments_v(spark, sf), orders_ev(spark, sf))
    return metrics_rows(turnover, ratio_metric(payments_v(spark, sf)))


def _ratio_keys_of(spark, sf, event_type: str) -> DataFrame:
    ev = read_table(spark, sf, "events").where(F.col("event_type") == event_type)
    secs = minute_epoch_seconds(minute_index(epoch_millis_ntz("ts")))
    return ev.select(result_key(RATIO_PREFIX, DEFAULT_TEAM, secs).alias("key"))


def q_metrics_rows(spark, sf):
    return _metrics(spark, sf)


def q_lookup_metrics(spark, sf):
    return lookup_metrics(_metrics(spark, sf), _ratio_keys_of(spark, sf, "purchase"))


def q_remove_metrics(spark, sf):
    return remove_metrics(_metrics(spark, sf), _ratio_keys_of(spark, sf, "error"))


def q_wireless_pc_ratio_reset_changed(spark, sf):
    """D2 feeding W3, as the reference's unwired dispatch -> ratio chain."""
    return wireless_pc_ratio_reset(changed_payments(_norm(payments_v(spark, sf))))


BATCH_QUERIES: dict[str, Query] = {
    "payments_normalised": q_payments_normalised,
    "payments_truncated": q_payments_truncated,
    "decoded_payments": q_decoded_payments,
    "topic_routing": q_topic_routing,
    "drop_end_markers": q_drop_end_markers,
    "delimited_orders": q_delimited_orders,
    "exact_arith": q_exact_arith,
    "exact_arith_wide": q_exact_arith_wide,
    "rejected_payments": q_rejected_payments,
    "delimited_check": q_delimited_check,
    "fingerprints": q_fingerprints,
    "positive_payments": q_positive_payments,
    "order_reconciliation": q_order_reconciliation,
    "matched_payments": q_matched_payments,
    "platform_payments": q_platform_payments,
    "first_orders": q_first_orders,
    "pending_payments": q_pending_payments,
    "set_matched": q_set_matched,
    "arrived_matched": q_arrived_matched,
    "distinct_payments": q_distinct_payments,
    "changed_payments": q_changed_payments,
    "platform_minute_turnover": q_platform_minute_turnover,
    "platform_minute_turnover_events": q_platform_minute_turnover_events,
    "device_minute_turnover": q_device_minute_turnover,
    "minute_turnover_nodedup": q_minute_turnover_nodedup,
    "minutes_seen": q_minutes_seen,
    "cumulative_turnover": q_cumulative_turnover,
    "wireless_pc_ratio": q_wireless_pc_ratio,
    "wireless_pc_ratio_reset": q_wireless_pc_ratio_reset,
    "wireless_pc_ratio_reset_changed": q_wireless_pc_ratio_reset_changed,
    "metrics_rows": q_metrics_rows,
    "lookup_metrics": q_lookup_metrics,
    "remove_metrics": q_remove_metrics,
}


def _configured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Query]:
    from tallyflow.streaming.queries import STREAM_QUERIES

    merged = {**BATCH_QUERIES, **STREAM_QUERIES}
    return {name: _configured(fn) for name, fn in merged.items()}
