"""Every operator on the hand-worked example (expected rows worked by hand)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyflow.functions import payment_fingerprint, to_cents
from tallyflow.operators import (
    changed_payments,
    cumulative_turnover,
    device_minute_turnover,
    distinct_payments,
    first_orders,
    match_arrived,
    match_by_set,
    match_payments,
    minutes_seen,
    pending_payments,
    reconcile_order_payments,
    wireless_pc_ratio,
    wireless_pc_ratio_reset,
)
from tallyflow.plans.metrics import platform_turnover, ratio_metric
from tallyflow.sinks import metrics_rows
from tallyflow.sources import payments_source
from tests.fixture import M0, orders_df, payments_df


@pytest.fixture(scope="module")
def pays(spark):
    return payments_source(payments_df(spark))


@pytest.fixture(scope="module")
def orders(spark):
    return orders_df(spark)


def names(df):
    return sorted(r["name"] for r in df.select("name").collect())


def test_cents_exact_and_truncate(spark):
    df = spark.createDataFrame([(19.99,)], "x double")
    r = df.select(to_cents("x").alias("e"), to_cents("x", "truncate").alias("t")).first()
    assert (r.e, r.t) == (1999, 1998)


def test_first_order_wins(orders):
    r = {x.order_id: x.platform for x in first_orders(orders).collect()}
    assert r == {1: 0, 2: 1, 3: 0}


def test_match_after_first(pays, orders):
    assert names(match_payments(pays, orders)) == ["p1", "p2", "p3", "p4", "p5", "p7", "p8"]


def test_pending(pays, orders):
    assert names(pending_payments(pays, orders)) == ["p6"]


def test_match_by_set(pays, orders):
    m = match_by_set(pays, orders)
    assert names(m.where("platform = 0")) == ["p1", "p2", "p3", "p7", "p8"]
    assert names(m.where("platform = 1")) == ["p4", "p5"]


def test_match_arrived(pays, orders):
    m = match_arrived(pays, orders)
    assert names(m.where("platform = 0")) == ["p1", "p2", "p3", "p7", "p8"]
    assert names(m.where("platform = 1")) == ["p3", "p5", "p8"]


def test_distinct_drops_p3(pays, orders):
    matched = match_payments(pays, orders)
    assert distinct_payments(matched).count() == 6


def test_changed_drops_p3(pays):
    kept = changed_payments(pays).select("arrival").collect()
    assert sorted(r.arrival for r in kept) == [11, 21, 611, 701, 801, 1801, 2401]
    fp = pays.where("name = 'p2'").select(
        payment_fingerprint("amount_cents", "pay_source", "pay_platform", "minute").alias("fp")
    )
    assert fp.first().fp == 24465391


def test_platform_turnover(spark):
    got = {
        (r.platform, r.minute - M0): r.turnover
        for r in platform_turnover(payments_df(spark), orders_df(spark)).collect()
    }
    assert got == {(0, 0): 29.99, (0, 3): 1.0, (0, 4): 2.0, (1, 1): 10.0}


def test_device_cumulative_and_ratio(pays):
    dev = device_minute_turnover(pays)
    assert {(r.minute - M0): (r.pc_cents, r.wl_cents) for r in dev.collect()} == {
        0: (1000, 3998), 1: (1150, 550), 3: (0, 100), 4: (200, 0),
    }
    cum = cumulative_turnover(dev)
    assert [(r.cum_pc_cents, r.cum_wl_cents) for r in cum.orderBy("minute").collect()] == [
        (1000, 3998), (2150, 4548), (2150, 4648), (2350, 4648),
    ]
    ratio = [r.ratio for r in wireless_pc_ratio(cum).orderBy("minute").collect()]
    assert ratio == [3.998, 2.1153488372093023, 2.161860465116279, 1.9778723404255318]


def test_ratio_reset(pays):
    got = [r.ratio for r in wireless_pc_ratio_reset(pays).orderBy("minute").collect()]
    assert got == [3.998, 2.1153488372093023, 1.7976931348623157e308, 0.0]


def test_minutes_seen(pays):
    r = minutes_seen(pays).first()
    assert (r.minutes, r.complete) == (4, False)


def test_reconciliation(orders, spark):
    o = orders.where("name <> 'o2'")
    bad = reconcile_order_payments(o, payments_df(spark)).collect()
    assert [(r.order_id, r.total_cents, r.paid_cents) for r in bad] == [(2, 1200, 1000)]
    # With the repeated order o2 kept, J2 reduces it first.
    bad = reconcile_order_payments(orders, payments_df(spark), arrival_col="arrival").collect()
    assert [(r.order_id, r.total_cents, r.paid_cents) for r in bad] == [(2, 1200, 1000)]


def test_metric_keys(spark):
    rows = metrics_rows(
        platform_turnover(payments_df(spark), orders_df(spark)), ratio_metric(payments_df(spark)), team="t"
    )
    keys = sorted(r.key for r in rows.where(F.col("key").startswith("ratio_")).collect())
    assert keys == ["ratio_t_1467849600", "ratio_t_1467849660", "ratio_t_1467849780", "ratio_t_1467849840"]
