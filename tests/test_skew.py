"""Hot keys: one order id holds a third of all payments. With broadcasts
off, joins run as shuffle joins; AQE must split the hot partition and the
results must equal brute force. Every aggregate keeps its partial step."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tallyflow.operators import match_by_set, match_payments, pending_payments
from tallyflow.plans.metrics import platform_turnover

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    rng = np.random.default_rng(3)
    n = 60_000
    oid = np.where(rng.random(n) < 1 / 3, 7, rng.integers(0, 3000, n))
    pays = pd.DataFrame(
        {
            "arrival": np.arange(n, dtype="int64"),
            "order_id": oid.astype("int64"),
            "pay_amount": rng.integers(1, 10_000, n) / 100,
            "pay_source": rng.integers(0, 4, n).astype("int32"),
            "pay_platform": rng.integers(0, 2, n).astype("int32"),
            "create_time_ms": rng.integers(0, 50, n).astype("int64") * 60_000,
        }
    )
    orders = pd.DataFrame(
        {"arrival": np.arange(2500, dtype="int64"), "order_id": np.arange(2500, dtype="int64"),
         "platform": (np.arange(2500) % 2).astype("int32")}
    )
    yield pays, orders, spark.createDataFrame(pays), spark.createDataFrame(orders)
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _task_rows(df) -> list[int]:
    """Rows per partition of the join output (the reduce tasks)."""
    return df.groupBy(F.spark_partition_id().alias("pid")).count().select("count").toPandas()["count"].tolist()


def test_hot_key_join_is_salted_and_correct(skewed):
    pays, orders, p, o = skewed
    m = match_payments(p, o, rows_per_task=2_000)
    rows = m.select("arrival", "platform").collect()
    got = pd.DataFrame(rows, columns=["arrival", "platform"]).sort_values("arrival").reset_index(drop=True)
    exp = pays.merge(orders[["order_id", "platform"]], on="order_id")[["arrival", "platform"]]
    assert got.equals(exp.sort_values("arrival").reset_index(drop=True).astype(got.dtypes))
    # The plain join puts the hot id's third of the rows in one task; the
    # salted join spreads it, so its largest task is clearly smaller.
    plain = match_payments(p, o, rows_per_task=None)
    assert max(_task_rows(plain)) >= len(exp) / 3
    assert max(_task_rows(m)) < 0.75 * max(_task_rows(plain))


@pytest.mark.parametrize("rows_per_task", [2_000, None])
def test_hot_key_anti_semi_joins_are_correct(skewed, rows_per_task):
    pays, orders, p, o = skewed
    got = pending_payments(p, o, rows_per_task=rows_per_task).count()
    assert got == int((~pays.order_id.isin(orders.order_id)).sum())
    got = match_by_set(p, o, rows_per_task=rows_per_task).count()
    assert got == int(pays.order_id.isin(orders.order_id).sum())


@pytest.mark.parametrize("rows_per_task", [2_000, None])
def test_hot_key_turnover_is_correct(skewed, rows_per_task):
    pays, orders, p, o = skewed
    t = platform_turnover(p, o, rows_per_task=rows_per_task)
    got = {(r.platform, r.minute): r.turnover_cents for r in t.collect()}
    plan = t._jdf.queryExecution().executedPlan().toString()
    if rows_per_task is not None:  # the hot id is salted: shuffled on (order_id, _salt)
        assert "_salt" in plan
    cents = (pays.pay_amount * 100).round().astype("int64")
    d = pays.assign(amount_cents=cents, minute=pays.create_time_ms // 60_000)
    d = d.drop_duplicates(["order_id", "amount_cents", "pay_source", "pay_platform", "minute"])
    d = d.merge(orders[["order_id", "platform"]], on="order_id")
    exp = d.groupby(["platform", "minute"]).amount_cents.sum().to_dict()
    assert got == exp


def test_null_ids_are_salted(skewed):
    pays, orders, p, o = skewed
    p = p.withColumn("order_id", F.when(F.col("order_id") != 7, F.col("order_id")))
    pending = pending_payments(p, o, rows_per_task=2_000)
    hot = pays.order_id == 7
    assert pending.count() == int(hot.sum() + (~hot & ~pays.order_id.isin(orders.order_id)).sum())
    assert max(_task_rows(pending)) < hot.sum() / 2


def test_salts_grow_with_the_id(spark):
    from tallyflow.operators.skew import hot_keys, hot_table, salted

    per_task = 500
    largest = []
    for rows in (4_000, 40_000):  # the hot id grows tenfold, its salts do too
        df = spark.range(rows).select(F.lit(7).alias("order_id"), F.col("id").alias("arrival")).unionByName(
            spark.range(2_000).select((F.col("id") + 100).cast("int").alias("order_id"), "id").toDF("order_id", "arrival")
        )
        table = hot_table(hot_keys(df, "order_id", per_task, fraction=0.5))
        counts = salted(df, table, "order_id", df.columns).groupBy("order_id", "_salt").count()
        largest.append(counts.agg(F.max("count")).first()[0])
    assert max(largest) < 2 * per_task


def test_ratio_counts_copies_once_when_asked(spark):
    from tallyflow.plans.metrics import ratio_metric

    rows = [(1, 1, 2.0, 0, 0, 60_000), (2, 1, 2.0, 0, 0, 60_000), (3, 1, 1.0, 0, 1, 60_000)]
    df = spark.createDataFrame(rows, "arrival long, order_id long, pay_amount double, pay_source int, pay_platform int, create_time_ms long")
    assert ratio_metric(df).first().ratio == 0.25 and ratio_metric(df, dedup=True).first().ratio == 0.5
