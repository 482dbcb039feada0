"""Streaming behaviour: the lateness bound (T2), emit-on-close (T3) and the
idempotent versioned upsert (K1)."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from tallyflow.session import shared_path
from tallyflow.sinks import MetricsTable
from tallyflow.streaming.feeds import read_feed
from tallyflow.streaming.turnover import start_closed_minutes, start_turnover_upsert, turnover_stream
from tests.fixture import T0

SCHEMA = "arrival long, order_id long, pay_amount double, pay_source int, pay_platform int, create_time_ms long"


def _append(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _pay(arrival, minute, amount):
    return (arrival, 1, amount, 0, 0, T0 + minute * 60_000 + 1_000)


def test_late_rows_current_minus_5_kept_minus_6_dropped(spark):
    feed = shared_path(spark, "test_late", unique=True)
    _append(spark, feed, [_pay(1, 10, 3.00)])
    _append(spark, feed, [_pay(2, 10, 4.00)])  # filler: the watermark moves between batches
    _append(spark, feed, [_pay(3, 5, 1.00), _pay(4, 4, 2.00)])
    orders = spark.createDataFrame([(1, 0)], "order_id long, platform int")
    stream = read_feed(spark, feed, SCHEMA)
    table = MetricsTable(spark, shared_path(spark, "test_late_table", unique=True))
    q = start_turnover_upsert(turnover_stream(stream, orders), table, shared_path(spark, "ck", unique=True), team="t")
    q.awaitTermination()
    got = {r.key: r.value for r in table.read().collect()}
    m0 = T0 // 60_000
    assert got == {
        f"platformTaobao_t_{(m0 + 10) * 60}": 7.0,
        f"platformTaobao_t_{(m0 + 5) * 60}": 1.0,
    }


def test_append_mode_withholds_open_minutes(spark):
    feed = shared_path(spark, "test_append", unique=True)
    for i, minute in enumerate([0, 1, 2, 3, 10, 11]):
        _append(spark, feed, [_pay(i, minute, 1.00)])
    orders = spark.createDataFrame([(1, 0)], "order_id long, platform int")
    out = shared_path(spark, "test_append_out", unique=True)
    turnover = turnover_stream(read_feed(spark, feed, SCHEMA), orders)
    q = start_closed_minutes(turnover, out, shared_path(spark, "ck", unique=True))
    q.awaitTermination()
    m0 = T0 // 60_000
    minutes = sorted(r.minute - m0 for r in spark.read.parquet(out).collect())
    # Watermark after minute 11 is 11 - 6 = 5: windows ending by then are closed.
    assert minutes == [0, 1, 2, 3]


def test_upsert_is_idempotent_and_last_write_wins(spark):
    table = MetricsTable(spark, shared_path(spark, "test_upsert", unique=True))
    kv = "key string, value double"
    table.upsert(spark.createDataFrame([("a", 1.0), ("b", 2.0)], kv), 0)
    table.upsert(spark.createDataFrame([("b", 3.0), ("c", 4.0)], kv), 1)
    first = sorted(map(tuple, table.read().collect()))
    table.upsert(spark.createDataFrame([("b", 3.0), ("c", 4.0)], kv), 1)  # a retried batch
    assert sorted(map(tuple, table.read().collect())) == first == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert table.versions() == [0, 1]
    seq = spark.createDataFrame([("d", 1.0, 2), ("d", 9.0, 1)], "key string, value double, seq int")
    table.upsert(seq, 2, order_col="seq")
    assert table.read().where(F.col("key") == "d").first().value == 1.0


def test_complete_mode_snapshot_equals_update(spark):
    feed = shared_path(spark, "test_complete", unique=True)
    for i, (minute, amount) in enumerate([(0, 1.25), (0, 2.00), (1, 1.25), (3, 1.25)]):
        _append(spark, feed, [_pay(i, minute, amount)])
    orders = spark.createDataFrame([(1, 1)], "order_id long, platform int")
    results = []
    for mode in ("update", "complete"):
        table = MetricsTable(spark, shared_path(spark, f"test_{mode}", unique=True))
        q = start_turnover_upsert(
            turnover_stream(read_feed(spark, feed, SCHEMA), orders), table,
            shared_path(spark, "ck", unique=True), team="t", output_mode=mode,
        )
        q.awaitTermination()
        results.append(sorted(map(tuple, table.read().collect())))
    assert results[0] == results[1] and [v for _, v in results[0]] == [3.25, 1.25, 1.25]


def test_stream_stream_match_on_fixture(spark):
    from tallyflow.streaming.matching import match_payments_stream
    from tests.fixture import orders_df, payments_df

    def feed(df, name, cols):
        path = shared_path(spark, name, unique=True)
        for (row,) in df.select(F.struct(*cols).alias("r")).orderBy("arrival").collect():
            spark.createDataFrame([tuple(row)], df.select(*cols).schema).write.mode("append").parquet(path)
        return read_feed(spark, path, df.select(*cols).schema)

    pcols = ["name", "arrival", "order_id", "pay_amount", "pay_source", "pay_platform", "create_time_ms"]
    ocols = ["arrival", "order_id", "platform", "create_time_ms"]
    for horizon in (None, 10):
        pays = feed(payments_df(spark), "fx_pay", pcols)
        orders = feed(orders_df(spark), "fx_orders", ocols)
        out = shared_path(spark, "fx_out", unique=True)
        m = match_payments_stream(pays, orders, horizon_minutes=horizon).select("name", "platform")
        q = (m.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", shared_path(spark, "ck", unique=True))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        got = sorted(map(tuple, spark.read.parquet(out).collect()))
        assert got == [("p1", 0), ("p2", 0), ("p3", 0), ("p4", 1), ("p5", 1), ("p7", 0), ("p8", 0)], horizon


def test_tombstones_and_compaction(spark):
    table = MetricsTable(spark, shared_path(spark, "test_compact", unique=True))
    kv = "key string, value double"
    table.upsert(spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], kv), 0)
    table.remove(spark.createDataFrame([("b",)], "key string"), 1)
    table.upsert(spark.createDataFrame([("a", 5.0)], kv), 2)
    before = sorted(map(tuple, table.read().collect()))
    assert before == [("a", 5.0), ("c", 3.0)]
    assert sorted(map(tuple, table.read(before=2).collect())) == [("a", 1.0), ("c", 3.0)]
    with pytest.raises(ValueError):
        table.compact(1)  # batch 2 exists: compaction must cover the newest batch
    table.compact(2)
    table.upsert(spark.createDataFrame([("b", 7.0)], kv), 3)
    assert sorted(map(tuple, table.read().collect())) == [("a", 5.0), ("b", 7.0), ("c", 3.0)]
    assert sorted(map(tuple, table.read(before=3).collect())) == before
    assert sorted(map(tuple, table.read(before=2).collect())) == [("a", 1.0), ("c", 3.0)]
    table.compact(3)  # a second generation
    table.upsert(spark.createDataFrame([("c", 9.0)], kv), 4)
    assert sorted(map(tuple, table.read().collect())) == [("a", 5.0), ("b", 7.0), ("c", 9.0)]
    assert table.versions() == [0, 1, 2, 3, 4]


def test_arrival_order_ratio_adds_late_payment_to_current_minute(spark):
    from tallyflow.streaming.turnover import ArrivalOrderRatio

    feed = shared_path(spark, "test_t6", unique=True)
    # arrival, minute, amount, device (0 PC, 1 wireless); the wireless 3.00 of
    # minute 0 arrives after minute 1 opened.
    rows = [(1, 0, 10.00, 0), (2, 1, 5.00, 1), (3, 0, 3.00, 1), (4, 2, 2.00, 0)]
    for arrival, minute, amount, device in rows:
        _append(spark, feed, [(arrival, 1, amount, 0, device, T0 + minute * 60_000 + 1_000)])
    ratio = ArrivalOrderRatio(spark, shared_path(spark, "test_t6_out", unique=True), team="t")
    ratio.start(read_feed(spark, feed, SCHEMA), shared_path(spark, "ck", unique=True)).awaitTermination()
    m0 = T0 // 60_000
    got = {r.key: r.value for r in ratio.table.read().collect()}
    assert got == {
        f"ratio_t_{m0 * 60}": 0.0,
        f"ratio_t_{(m0 + 1) * 60}": 0.8,
        f"ratio_t_{(m0 + 2) * 60}": 8 / 12,
    }


def test_live_metrics_with_compaction_equal_batch_metrics(spark):
    from tallyflow.plans.metrics import platform_turnover, ratio_metric
    from tallyflow.sinks import metrics_rows
    from tallyflow.streaming.live import LiveMetrics
    from tests.fixture import orders_df, payments_df

    pays, orders = payments_df(spark).drop("name"), orders_df(spark).drop("name", "total_price")
    pay_feed, order_feed = shared_path(spark, "live_pay", unique=True), shared_path(spark, "live_ord", unique=True)
    # Three slices of each feed, in arrival order.
    for lo, hi in [(0, 30), (30, 700), (700, 10_000)]:
        pays.where(f"arrival >= {lo} AND arrival < {hi}").coalesce(1).write.mode("append").parquet(pay_feed)
        orders.where(f"arrival >= {lo} AND arrival < {hi}").coalesce(1).write.mode("append").parquet(order_feed)
    live = LiveMetrics(spark, shared_path(spark, "live_out", unique=True), team="t", compact_every=1)
    queries = live.start(
        read_feed(spark, pay_feed, pays.schema), read_feed(spark, order_feed, orders.schema),
        shared_path(spark, "live_ck", unique=True),
    )
    for q in queries:
        q.awaitTermination()
    want = metrics_rows(platform_turnover(pays, orders), ratio_metric(pays), team="t")
    assert sorted(map(tuple, live.metrics().collect())) == sorted(map(tuple, want.collect()))
    assert live.cents._latest_snapshot(None) is not None


def test_minutes_seen_on_a_stream(spark):
    from tallyflow.operators import minutes_seen_approx
    from tallyflow.sources import payments_source

    feed = shared_path(spark, "test_a4", unique=True)
    for i, minute in enumerate([0, 0, 1, 5, 5, 9]):
        _append(spark, feed, [_pay(i, minute, 1.00)])
    out = minutes_seen_approx(payments_source(read_feed(spark, feed, SCHEMA)), expected=4)
    q = (out.writeStream.outputMode("complete").format("memory").queryName("a4_test")
         .option("checkpointLocation", shared_path(spark, "ck", unique=True)).trigger(availableNow=True).start())
    q.awaitTermination()
    r = spark.sql("SELECT * FROM a4_test").first()
    assert (r.minutes, r.complete) == (4, True)


def test_restart_from_checkpoint_equals_batch(spark):
    from tallyflow.operators import first_orders
    from tallyflow.plans.metrics import platform_turnover
    from tallyflow.sources import orders_ev, payments_v

    sf = "/root/testdata/sf0.001"
    pays, orders = payments_v(spark, sf), orders_ev(spark, sf)
    feed = shared_path(spark, "restart_feed", unique=True)
    ck = shared_path(spark, "restart_ck", unique=True)
    table = MetricsTable(spark, shared_path(spark, "restart_table", unique=True))
    known = first_orders(orders).select("order_id", "platform")
    cut = pays.approxQuantile("arrival", [0.5], 0.0)[0]
    for part in (pays.where(F.col("arrival") < cut), pays.where(F.col("arrival") >= cut)):
        part.coalesce(1).sortWithinPartitions("arrival").write.mode("append").parquet(feed)
        q = start_turnover_upsert(turnover_stream(read_feed(spark, feed, pays.schema), known), table, ck, team="t")
        q.awaitTermination()
    want = platform_turnover(pays, orders)
    from tallyflow.streaming.turnover import turnover_metric_rows

    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, turnover_metric_rows(want, "t").collect()))
    assert len(table.versions()) >= 2


def test_duplicate_within_watermark_counted_once(spark):
    feed = shared_path(spark, "test_dup", unique=True)
    _append(spark, feed, [_pay(1, 3, 2.50)])
    _append(spark, feed, [_pay(2, 4, 1.00), _pay(3, 3, 2.50)])  # redelivered copy, same minute
    _append(spark, feed, [_pay(4, 3, 2.50)])  # and again, a batch later
    orders = spark.createDataFrame([(1, 0)], "order_id long, platform int")
    table = MetricsTable(spark, shared_path(spark, "test_dup_t", unique=True))
    q = start_turnover_upsert(turnover_stream(read_feed(spark, feed, SCHEMA), orders), table,
                              shared_path(spark, "ck", unique=True), team="t")
    q.awaitTermination()
    m0 = T0 // 60_000
    got = {r.key: r.value for r in table.read().collect()}
    assert got == {f"platformTaobao_t_{(m0 + 3) * 60}": 2.5, f"platformTaobao_t_{(m0 + 4) * 60}": 1.0}


def test_changed_payments_state_timeout(spark):
    from tallyflow.operators import changed_payments
    from tallyflow.sources import payments_source, payments_v, redelivered
    from tallyflow.streaming.feeds import write_feed
    from tallyflow.streaming.state import changed_payments_stream

    pays = redelivered(payments_v(spark, "/root/testdata/sf0.001"))
    feed = write_feed(pays, shared_path(spark, "test_d2_timeout", unique=True), slices=3, files_per_slice=1)
    want = sorted(r.arrival for r in changed_payments(payments_source(pays)).collect())
    for timeout in (None, 60 * 24 * 90):  # the feed spans one month
        out = shared_path(spark, "test_d2_out", unique=True)
        q = (changed_payments_stream(read_feed(spark, feed, pays.schema), timeout_minutes=timeout)
             .writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", shared_path(spark, "ck", unique=True)).trigger(availableNow=True).start())
        q.awaitTermination()
        assert sorted(r.arrival for r in spark.read.parquet(out).collect()) == want, timeout


def test_empty_batch_upsert_keeps_table_readable(spark):
    table = MetricsTable(spark, shared_path(spark, "test_empty", unique=True))
    kv = "key string, value double"
    table.upsert(spark.createDataFrame([("a", 1.0)], kv), 0)
    table.upsert(spark.createDataFrame([], kv), 1)
    assert sorted(map(tuple, table.read().collect())) == [("a", 1.0)]
    empty = MetricsTable(spark, shared_path(spark, "test_empty2", unique=True))
    empty.upsert(spark.createDataFrame([], kv), 0)
    assert empty.read().collect() == []


def test_live_flow_counts_payment_released_long_after_its_minute(spark):
    from tallyflow.streaming.live import LiveMetrics

    ord_schema = "arrival long, order_id long, platform int, create_time_ms long"
    pay_feed, ord_feed = shared_path(spark, "rel_pay", unique=True), shared_path(spark, "rel_ord", unique=True)
    # batch 0: order 5's payment (minute 0) waits; order 6 and its payment are known.
    _append(spark, pay_feed, [(1, 5, 4.00, 0, 0, T0 + 1_000)])
    spark.createDataFrame([(2, 6, 1, T0)], ord_schema).write.mode("append").parquet(ord_feed)
    # batch 1: order 6 pays two hours later: the watermark moves far past minute 0.
    _append(spark, pay_feed, [(3, 6, 2.00, 0, 0, T0 + 120 * 60_000)])
    spark.createDataFrame([(4, 7, 1, T0 + 120 * 60_000)], ord_schema).write.mode("append").parquet(ord_feed)
    # batch 2: a filler payment, then order 5 finally arrives.
    _append(spark, pay_feed, [(5, 6, 3.00, 0, 0, T0 + 121 * 60_000)])
    spark.createDataFrame([(6, 5, 0, T0 + 121 * 60_000)], ord_schema).write.mode("append").parquet(ord_feed)
    live = LiveMetrics(spark, shared_path(spark, "rel_out", unique=True), team="t")
    for q in live.start(read_feed(spark, pay_feed, SCHEMA), read_feed(spark, ord_feed, ord_schema),
                        shared_path(spark, "rel_ck", unique=True)):
        q.awaitTermination()
    m0 = T0 // 60_000
    got = {r.key: r.value for r in live.metrics().collect() if r.key.startswith("platform")}
    assert got == {
        f"platformTaobao_t_{m0 * 60}": 4.0,
        f"platformTmall_t_{(m0 + 120) * 60}": 2.0,
        f"platformTmall_t_{(m0 + 121) * 60}": 3.0,
    }


def test_per_platform_watermarks_judge_lateness_per_platform(spark):
    from tallyflow.streaming.turnover import start_platform_turnover_upserts

    feed = shared_path(spark, "test_pp", unique=True)
    # order 1 is Taobao, order 2 Tmall. Taobao runs 30 minutes ahead of Tmall.
    _append(spark, feed, [(1, 1, 1.00, 0, 0, T0 + 30 * 60_000 + 1_000), (2, 2, 2.00, 0, 0, T0 + 1_000)])
    _append(spark, feed, [(3, 1, 1.00, 0, 0, T0 + 31 * 60_000 + 1_000)])  # filler
    _append(spark, feed, [(4, 2, 5.00, 0, 0, T0 + 60_000 + 1_000)])  # Tmall minute 1: late only globally
    orders = spark.createDataFrame([(1, 0), (2, 1)], "order_id long, platform int")
    m0 = T0 // 60_000
    tmall_key = f"platformTmall_t_{(m0 + 1) * 60}"
    # One query over both platforms: Tmall minute 1 is behind the global watermark.
    both = MetricsTable(spark, shared_path(spark, "pp_both", unique=True))
    start_turnover_upsert(turnover_stream(read_feed(spark, feed, SCHEMA), orders), both,
                          shared_path(spark, "ck", unique=True), team="t").awaitTermination()
    assert tmall_key not in {r.key for r in both.read().collect()}
    # One query per platform: Tmall's own newest minute is 1, nothing is late.
    tables = {p: MetricsTable(spark, shared_path(spark, f"pp_{p}", unique=True)) for p in (0, 1)}
    for q in start_platform_turnover_upserts(read_feed(spark, feed, SCHEMA), orders, tables,
                                             shared_path(spark, "ck", unique=True), team="t"):
        q.awaitTermination()
    got = {r.key: r.value for t in tables.values() for r in t.read().collect()}
    assert got[tmall_key] == 5.0 and got[f"platformTmall_t_{m0 * 60}"] == 2.0
    assert got[f"platformTaobao_t_{(m0 + 30) * 60}"] == 1.0


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_periodic_snapshot_trigger(spark, mode):
    feed = shared_path(spark, "test_periodic", unique=True)
    for i, minute in enumerate([0, 1, 2]):
        _append(spark, feed, [_pay(i, minute, 1.50)])
    orders = spark.createDataFrame([(1, 0)], "order_id long, platform int")
    table = MetricsTable(spark, shared_path(spark, "test_periodic_t", unique=True))
    q = start_turnover_upsert(
        turnover_stream(read_feed(spark, feed, SCHEMA), orders), table, shared_path(spark, "ck", unique=True),
        trigger={"processingTime": "1 second"}, team="t", output_mode=mode,
    )
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(v for _, v in map(tuple, table.read().collect())) == [1.5, 1.5, 1.5]


def test_bounded_ingest_one_file_per_batch(spark):
    feed = shared_path(spark, "test_s6", unique=True)
    for i in range(4):
        _append(spark, feed, [_pay(2 * i, i, 1.0), _pay(2 * i + 1, i, 2.0)])
    out = shared_path(spark, "test_s6_out", unique=True)
    q = (read_feed(spark, feed, SCHEMA, max_files_per_trigger=1).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", shared_path(spark, "ck", unique=True))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"] > 0]
    assert sizes == [2, 2, 2, 2]


def test_topic_messages_through_the_live_flow(spark):
    """Encoded messages on three topics (with end markers) -> decode ->
    live flow; a file stream stands in for the broker."""
    from tallyflow.constants import END_MARKER
    from tallyflow.plans.metrics import platform_turnover, ratio_metric
    from tallyflow.sinks import metrics_rows
    from tallyflow.sources.topics import decode_orders, decode_payments
    from tallyflow.streaming.live import LiveMetrics
    from tests.fixture import orders_df, payments_df

    pays, orders = payments_df(spark).drop("name"), orders_df(spark).drop("name")
    pay_msgs = pays.select(
        F.lit("pay").alias("topic"),
        F.col("arrival").alias("offset"),
        F.to_json(F.struct(
            F.col("order_id").alias("orderId"), F.col("pay_amount").alias("payAmount"),
            F.col("pay_source").alias("paySource"), F.col("pay_platform").alias("payPlatform"),
            F.col("create_time_ms").alias("createTime"),
        )).cast("binary").alias("value"),
    )
    order_msgs = orders.select(
        F.when(F.col("platform") == 0, F.lit("tb")).otherwise(F.lit("tm")).alias("topic"),
        F.col("arrival").alias("offset"),
        F.to_json(F.struct(
            F.col("order_id").alias("orderId"), F.col("create_time_ms").alias("createTime"),
            F.col("total_price").alias("totalPrice"),
        )).cast("binary").alias("value"),
    )
    markers = spark.createDataFrame(
        [(t, 10_000, bytearray(END_MARKER)) for t in ("pay", "tb", "tm")], "topic string, offset long, value binary"
    )
    msgs = pay_msgs.unionByName(order_msgs).unionByName(markers)
    feed = shared_path(spark, "topic_feed", unique=True)
    for lo, hi in [(0, 30), (30, 700), (700, 20_000)]:
        msgs.where(f"offset >= {lo} AND offset < {hi}").coalesce(1).write.mode("append").parquet(feed)
    stream = read_feed(spark, feed, msgs.schema)
    p = decode_payments(stream.where("topic = 'pay'")).withColumnRenamed("offset", "arrival")
    o = decode_orders(stream, "tb", "tm").withColumnRenamed("offset", "arrival")
    live = LiveMetrics(spark, shared_path(spark, "topic_live", unique=True), team="t")
    for q in live.start(p, o, shared_path(spark, "topic_ck", unique=True)):
        q.awaitTermination()
    want = metrics_rows(platform_turnover(pays, orders), ratio_metric(pays), team="t")
    assert sorted(map(tuple, live.metrics().collect())) == sorted(map(tuple, want.collect()))


def test_stream_turnover_without_dedup_counts_copies(spark):
    feed = shared_path(spark, "test_a3", unique=True)
    _append(spark, feed, [_pay(1, 0, 2.00), _pay(2, 0, 2.00)])  # a copy in the same minute
    _append(spark, feed, [_pay(3, 9, 1.00)])  # closes minute 0 (watermark 9 - 6 = 3)
    orders = spark.createDataFrame([(1, 0)], "order_id long, platform int")
    out = shared_path(spark, "test_a3_out", unique=True)
    q = start_closed_minutes(turnover_stream(read_feed(spark, feed, SCHEMA), orders, dedup=False), out,
                             shared_path(spark, "ck", unique=True))
    q.awaitTermination()
    m0 = T0 // 60_000
    assert [(r.minute - m0, r.turnover) for r in spark.read.parquet(out).collect()] == [(0, 4.0)]


def test_reset_ratio_stream_equals_batch_across_batches(spark):
    from tallyflow.operators import wireless_pc_ratio_reset
    from tallyflow.sources import payments_source
    from tallyflow.streaming.reset_ratio import ResetRatioStream

    feed = shared_path(spark, "test_w3", unique=True)
    batches = [
        [(1, 1, 10.00, 0, 0, 0), (2, 1, 5.00, 0, 0, 1)],  # PC minutes 0, 1
        [(3, 1, 3.00, 0, 1, 1), (4, 1, 1.00, 0, 0, 2)],  # minute 1 spans batches; PC run continues
        [(5, 1, 2.00, 0, 1, 4), (6, 1, 4.00, 0, 0, 5)],  # gap: runs restart
    ]
    rows = []
    for batch in batches:
        data = [(a, o, amt, src, dev, T0 + m * 60_000 + 1_000) for a, o, amt, src, dev, m in batch]
        rows += data
        _append(spark, feed, data)
    w3 = ResetRatioStream(spark, shared_path(spark, "test_w3_out", unique=True), team="team")
    w3.start(read_feed(spark, feed, SCHEMA), shared_path(spark, "ck", unique=True)).awaitTermination()
    got = {r.key: r.value for r in w3.table.read().collect()}
    batch = wireless_pc_ratio_reset(payments_source(spark.createDataFrame(rows, SCHEMA)))
    want = {f"ratio_team_{r.minute * 60}": r.ratio for r in batch.collect()}
    assert got == want and len(got) == 5


def test_first_order_by_arrival_whatever_the_file_order(spark):
    import random

    from tallyflow.operators import first_orders
    from tallyflow.streaming.matching import match_payments_stream

    rng = random.Random(3)
    rows = [(k, rng.randrange(500), rng.randrange(2), T0) for k in range(5000)]
    orders = spark.createDataFrame(rows, "arrival long, order_id long, platform int, create_time_ms long")
    pays = spark.createDataFrame([(k, k, 1.0, 0, 0, T0) for k in range(500)], SCHEMA)
    feeds = []
    for name, df in (("ff_orders", orders), ("ff_pays", pays)):
        path = shared_path(spark, name, unique=True)
        df.repartition(16).write.parquet(path)  # 16 files in no order, one batch
        feeds.append(read_feed(spark, path, df.schema, 16))
    out = shared_path(spark, "ff_out", unique=True)
    q = (match_payments_stream(feeds[1], feeds[0]).select("order_id", "platform").writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", shared_path(spark, "ck", unique=True))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    want = {r.order_id: r.platform for r in first_orders(orders).collect()}
    assert {r.order_id: r.platform for r in spark.read.parquet(out).collect()} == want


def test_tied_arrivals_give_one_ratio(spark):
    import random

    from tallyflow.streaming.turnover import ArrivalOrderRatio

    rng = random.Random(4)
    rows = [(k // 7, 1, 1.0 + k % 5, 0, k % 2, T0 + rng.randrange(20) * 60_000) for k in range(300)]
    results = []
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(rows)
        ratio = ArrivalOrderRatio(spark, shared_path(spark, "tied", unique=True), team="t")
        ratio.process(spark.createDataFrame(rows, SCHEMA).repartition(seed), 0)
        results.append(sorted(map(tuple, ratio.table.read().collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) > 1


def test_ratio_reset_with_late_payments_equals_batch(spark):
    from tallyflow.functions.codes import result_key
    from tallyflow.functions.time import minute_epoch_seconds
    from tallyflow.operators import wireless_pc_ratio_reset
    from tallyflow.sources import payments_source
    from tallyflow.streaming.reset_ratio import ResetRatioStream

    batches = [
        [(1, 1, 1.00, 0, 0, 10), (2, 1, 1.00, 0, 1, 10)],
        [(3, 1, 2.00, 0, 0, 11), (4, 1, 1.00, 0, 0, 14)],
        [(5, 1, 0.50, 0, 1, 10), (6, 1, 4.00, 0, 1, 12)],  # both late
        [(7, 1, 1.00, 0, 0, 13)],  # closes the gap between 11 and 14
    ]
    batches = [[(*r[:5], T0 + r[5] * 60_000) for r in rows] for rows in batches]
    stream = ResetRatioStream(spark, shared_path(spark, "late_w3", unique=True), team="t", compact_every=2)
    for k, rows in enumerate(batches):
        stream.process(spark.createDataFrame(rows, SCHEMA), k)
        seen = spark.createDataFrame([r for b in batches[: k + 1] for r in b], SCHEMA)
        want = wireless_pc_ratio_reset(payments_source(seen)).select(
            result_key("ratio_", "t", minute_epoch_seconds("minute")).alias("key"), "ratio"
        )
        assert sorted(map(tuple, stream.table.read().collect())) == sorted(map(tuple, want.collect()))
    m10 = f"ratio_t_{(T0 // 60_000 + 10) * 60}"
    assert {r.key: r.value for r in stream.table.read().collect()}[m10] == 1.5


def test_batch_retried_after_its_compaction(spark):
    table = MetricsTable(spark, shared_path(spark, "test_retry", unique=True))
    kv = "key string, value double"
    table.upsert(spark.createDataFrame([("a", 1.0), ("b", 1.0)], kv), 0)
    table.upsert(spark.createDataFrame([("b", 2.0)], kv), 1)
    table.compact(1)
    table.upsert(spark.createDataFrame([("b", 3.0)], kv), 1)  # the retry has another value
    table.compact(1)
    assert sorted(map(tuple, table.read().collect())) == [("a", 1.0), ("b", 3.0)]
    some = table.read(keys=spark.createDataFrame([("a",), ("z",)], "key string"))
    assert sorted(map(tuple, some.collect())) == [("a", 1.0)]


def test_feed_slices_hold_several_files_in_arrival_order(spark):
    from tallyflow.streaming.feeds import write_feed

    rows = [(k if k else None, 1, 1.0, 0, 0, T0) for k in range(1000)]
    path = write_feed(spark.createDataFrame(rows, SCHEMA).repartition(5), shared_path(spark, "slices", unique=True), slices=3, files_per_slice=4)
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(top, True)
    times = {}
    while files.hasNext():
        f = files.next()
        if f.getPath().getName().startswith("part-"):
            times[f.getPath().toString()] = f.getModificationTime()
    assert len(times) == 12
    order = sorted(times, key=times.get)
    spans = [spark.read.schema(SCHEMA).parquet(*order[i : i + 4]).agg(F.min("arrival"), F.max("arrival"), F.count("*")).first() for i in (0, 4, 8)]
    assert spans[0][1] < spans[1][0] and spans[1][1] < spans[2][0] and sum(s[2] for s in spans) == 1000


def test_feed_reads_its_input_once_however_many_slices(spark):
    from tallyflow.streaming.feeds import write_feed

    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(4000).selectExpr("id arrival").mapInArrow(seen, "arrival long")
    counts = []
    for slices in (2, 12):
        before = read.value
        path = write_feed(rows, shared_path(spark, "once", unique=True), slices=slices, files_per_slice=2)
        counts.append(read.value - before)
        assert spark.read.option("recursiveFileLookup", "true").schema("arrival long").parquet(path).count() == 4000
    assert counts[0] == counts[1]


def test_changed_payments_state_is_per_page_of_ids(spark, monkeypatch):
    import random

    from tallyflow.operators import changed_payments
    from tallyflow.sources import payments_source
    from tallyflow.streaming import state

    monkeypatch.setattr(state, "PAGES", 3)
    rng = random.Random(8)
    rows = [(k, rng.choice([None, *range(200)]), float(rng.randrange(2)), 0, 0, T0) for k in range(3000)]
    path = shared_path(spark, "d2_pages", unique=True)
    for at in (0, 1000, 2000):
        spark.createDataFrame(rows[at : at + 1000], SCHEMA).repartition(1).write.mode("append").parquet(path)
    want = sorted(r.arrival for r in changed_payments(payments_source(spark.createDataFrame(rows, SCHEMA))).collect())
    for timeout in (None, 1000):
        out = shared_path(spark, "d2_pages_out", unique=True)
        q = (state.changed_payments_stream(read_feed(spark, path, spark.createDataFrame([], SCHEMA).schema), timeout)
             .writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", shared_path(spark, "ck", unique=True)).trigger(availableNow=True).start())
        q.awaitTermination()
        assert sorted(r.arrival for r in spark.read.parquet(out).collect()) == want
        assert q.recentProgress[-1].stateOperators[0].numRowsTotal <= 4


def test_first_orders_keep_no_state_in_python(spark):
    from tallyflow.streaming.matching import first_orders_stream

    schema = "arrival long, order_id long, platform int, create_time_ms long"
    path = shared_path(spark, "fo", unique=True)
    batches = [[(3, 1, 1, T0), (2, 1, 0, T0), (None, 2, 1, T0), (9, 2, 0, T0), (4, None, 0, T0)], [(5, 1, 1, T0), (6, 3, 1, T0)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(path)
    out = shared_path(spark, "fo_out", unique=True)
    q = (first_orders_stream(read_feed(spark, path, spark.createDataFrame([], schema).schema, 2)).writeStream.format("parquet")
         .option("path", out).option("checkpointLocation", shared_path(spark, "ck", unique=True)).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 0), (2, 0), (3, 1)]
    assert q.recentProgress[-1].stateOperators[0].operatorName == "dedupe"


def test_compaction_bounds_what_a_read_lists(spark):
    table = MetricsTable(spark, shared_path(spark, "test_bound", unique=True))
    for batch in range(9):
        table.upsert(spark.createDataFrame([("a", float(batch)), (f"k{batch}", 1.0)], "key string, value double"), batch)
        if batch % 3 == 2:
            table.compact(batch)
        now = table._generation(table._latest_snapshot(None))
        assert len(table._list(now, "batch=")) <= 3
    rows = dict(map(tuple, table.read().collect()))
    assert len(rows) == 10 and rows["a"] == 8.0
