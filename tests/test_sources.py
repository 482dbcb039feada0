"""Sources and quality rules: end markers, topic routing, the delimited
log with its header check, and the payment sign rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyflow.constants import END_MARKER
from tallyflow.operators import positive_payments, rejected_payments
from tallyflow.session import shared_path
from tallyflow.sources import (
    delimited_file_check,
    drop_end_markers,
    feed_completion,
    read_delimited_orders,
    route_by_topic,
    write_delimited_orders,
)
from tests.fixture import orders_df, payments_df


def test_end_markers(spark):
    msgs = spark.createDataFrame(
        [("pay", bytearray(b"x1")), ("pay", bytearray(END_MARKER)), ("tmall_orders", bytearray(b"y"))],
        "topic string, body binary",
    )
    assert drop_end_markers(msgs).count() == 2
    done = {r.topic: r.complete for r in feed_completion(msgs).collect()}
    assert done == {"pay": True, "tmall_orders": False}


def test_route_by_topic(spark):
    feed = spark.createDataFrame([("pay", 1), ("taobao_orders", 2), ("tmall_orders", 3), ("pay", 4)], "topic string, id int")
    routes = route_by_topic(feed)
    assert {k: v.count() for k, v in routes.items()} == {"pay": 2, "taobao_orders": 1, "tmall_orders": 1}


def test_delimited_round_trip_and_header_check(spark):
    path = shared_path(spark, "test_delimited", unique=True)
    orders = orders_df(spark).select("platform", "arrival", "order_id", "create_time_ms")
    write_delimited_orders(orders, path, n_files=2)
    back = read_delimited_orders(spark, path).select(*orders.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, orders.collect()))
    checks = delimited_file_check(spark, path).collect()
    assert checks and all(r.ok for r in checks)
    assert sum(r.declared for r in checks) == 4
    raw = spark.read.text(path).first().value
    assert ";;" in raw or raw.isdigit()


def test_positive_and_rejected(spark):
    p = payments_df(spark).unionByName(
        payments_df(spark).limit(2).withColumn("pay_amount", F.when(F.col("name") == "p1", -1.0).otherwise(0.0))
    )
    assert positive_payments(p).count() == 8
    rej = rejected_payments(p).collect()
    assert [(r.pay_amount, r.reason) for r in rej] == [(-1.0, "negative")]


def test_topic_decoding_drops_markers_and_tags_platform(spark):
    import json

    from tallyflow.sources.topics import decode_orders, decode_payments

    pay = json.dumps({"orderId": 1, "payAmount": 19.99, "paySource": 1, "payPlatform": 1, "createTime": 1467849602000})
    order = json.dumps({"orderId": 1, "buyerId": "b", "productId": "p", "salerId": "s", "createTime": 1, "totalPrice": 51.98})
    msgs = spark.createDataFrame(
        [
            ("pay", bytearray(pay.encode())),
            ("pay", bytearray(END_MARKER)),
            ("tb", bytearray(order.encode())),
            ("tm", bytearray(order.encode())),
            ("tm", bytearray(END_MARKER)),
        ],
        "topic string, value binary",
    )
    p = decode_payments(msgs.where("topic = 'pay'")).collect()
    assert [(r.order_id, r.pay_amount, r.pay_source, r.pay_platform) for r in p] == [(1, 19.99, 1, 1)]
    o = decode_orders(msgs, "tb", "tm").orderBy("platform").collect()
    assert [(r.order_id, r.platform, r.total_price) for r in o] == [(1, 0, 51.98), (1, 1, 51.98)]


def test_delimited_header_mismatch_is_reported(spark):
    path = shared_path(spark, "test_delimited_bad", unique=True)
    body = '{"arrival": 1, "order_id": 5, "create_time_ms": 7}'
    lines = spark.createDataFrame([("3",), ("0" + body,), ("1" + body,)], "value string").coalesce(1)
    lines.write.option("lineSep", ";;\n").text(path)
    check = delimited_file_check(spark, path).collect()
    assert [(r.declared, r.found, r.ok) for r in check] == [(3, 2, False)]
    assert sorted(r.platform for r in read_delimited_orders(spark, path).collect()) == [0, 1]


def test_bucketed_tables_join_without_shuffle(spark):
    from tallyflow.operators import first_orders
    from tallyflow.sources import orders_v, payments_li, write_bucketed

    sf = "/root/testdata/sf0.01"
    tag = shared_path(spark, "bucketed", unique=True).rsplit("/", 1)[-1]
    p = write_bucketed(payments_li(spark, sf), f"pay_{tag}", shared_path(spark, "bucketed", tag, "pay"), 8)
    o = write_bucketed(orders_v(spark, sf), f"ord_{tag}", shared_path(spark, "bucketed", tag, "ord"), 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        joined = p.join(o.select("order_id", "platform"), "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        plain = payments_li(spark, sf).join(orders_v(spark, sf).select("order_id", "platform"), "order_id")
        assert joined.count() == plain.count()
        # J2 over the bucketed orders keeps their partitioning: still no shuffle.
        j2 = p.join(first_orders(o, "create_time_ms").select("order_id", "platform"), "order_id")
        assert "Exchange" not in j2._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "32MB")


def test_route_to_folders_prunes_other_topics(spark):
    from tallyflow.sources import read_route, route_to_folders

    feed = spark.createDataFrame(
        [("pay", 1), ("taobao_orders", 2), ("tmall_orders", 3), ("pay", 4)], "topic string, id int"
    )
    path = route_to_folders(feed, shared_path(spark, "routes", unique=True))
    pay = read_route(spark, path, "pay")
    assert sorted(r.id for r in pay.collect()) == [1, 4]
    plan = pay._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_records_that_do_not_decode_are_rejects(spark):
    from tallyflow.constants import RECORD_SEPARATOR
    from tallyflow.session import shared_path
    from tallyflow.sources import delimited_file_check, delimited_rejects, read_delimited_orders

    path = shared_path(spark, "bad_log", unique=True)
    good = '0{"arrival":1,"order_id":7,"create_time_ms":5}'
    lines = ["5", good, "1garbage", "{}", '1{"order_id":"x"}']
    spark.createDataFrame([(RECORD_SEPARATOR.join(lines),)], "value string").coalesce(1).write.text(path)
    rows = read_delimited_orders(spark, path).collect()
    assert [(r.platform, r.arrival, r.order_id, r.create_time_ms) for r in rows] == [(0, 1, 7, 5)]
    bad = sorted(r.value.strip() for r in delimited_rejects(spark, path).collect())
    assert bad == sorted(lines[2:])
    check = delimited_file_check(spark, path).first()
    assert (check.declared, check.found, check.ok) == (5, 4, False)
