"""Registered queries on a skewed copy of ``events``: a third of all
payments moved onto one order id, salting thresholds lowered so the salted
plans run, and every result compared with its SQL on the same copy."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from tallyflow.operators.skew import ROWS_PER_TASK_CONF, SAMPLE_FRACTION_CONF
from tallyflow.session import shared_path
from tools.check_oracle import digest

HOT_ID = 7
QUERIES = [
    "matched_payments",
    "platform_payments",
    "set_matched",
    "arrived_matched",
    "distinct_payments",
    "changed_payments",
    "platform_minute_turnover_events",
    "minute_turnover_nodedup",
    "metrics_rows",
    "stream_changed_payments",
    "stream_metrics",
]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    src = "/root/testdata/sf0.01"
    out = shared_path(spark, "skewed_sf", unique=True)
    ev = spark.read.parquet(f"{src}/events.parquet")
    hot = (F.col("event_type") != "signup") & (F.col("event_id") % 3 == 0)
    ev.withColumn("user_id", F.when(hot, F.lit(HOT_ID)).otherwise(F.col("user_id"))).write.parquet(
        f"{out}/events.parquet"
    )
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{out}/events.parquet/*.parquet')")
    old = {k: spark.conf.get(k, None) for k in (ROWS_PER_TASK_CONF, SAMPLE_FRACTION_CONF)}
    spark.conf.set(ROWS_PER_TASK_CONF, "300")
    spark.conf.set(SAMPLE_FRACTION_CONF, "0.05")
    yield out, con
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_query_matches_oracle(spark, skewed_dir, name):
    out, con = skewed_dir
    df = entry_mod.queries()[name](spark, out)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry_mod.oracle_sql()[name])
    want = digest([c[0] for c in cur.description], cur.fetchall())
    assert digest(df.columns, rows)[:3] == want[:3]
    if name in ("matched_payments", "platform_minute_turnover_events"):
        assert "_salt" in df._jdf.queryExecution().executedPlan().toString()


def test_turnover_partitions_follow_the_rows(spark, monkeypatch):
    """Both sides are dealt over as many tasks as the payments' rows need."""
    from tallyflow.plans import metrics
    from tallyflow.sources import orders_v, payments_li

    sf = "/root/testdata/sf0.001"
    pays, orders = payments_li(spark, sf), orders_v(spark, sf)
    want = sorted(map(tuple, metrics.platform_turnover(pays, orders, "create_time_ms").collect()))
    monkeypatch.setattr(metrics, "ROWS_PER_PART", 100)
    many = metrics.platform_turnover(pays, orders, "create_time_ms")
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {-(-pays.count() // 100)}), REPARTITION_BY_NUM") == 2
    assert sorted(map(tuple, many.collect())) == want
