from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyflow.llm import common


@pytest.mark.parametrize("limit", [0, 2, 1000])
def test_keep_ids_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(common, "BROADCAST_ROWS", limit)
    rows = spark.createDataFrame([(k % 7 if k % 5 else None, k) for k in range(60)], "id long, v long")
    ids = common.staged(spark.createDataFrame([(1,), (3,), (9,)], "id long"), "test_ids")
    got = {r["v"] for r in common.keep_ids(rows, ids, "id").collect()}
    assert got == {k for k in range(60) if k % 5 and k % 7 in (1, 3)}
    rest = {r["v"] for r in common.keep_ids(rows, ids, "id", "left_anti").collect()}
    assert rest == set(range(60)) - got


@pytest.mark.parametrize("share", [1, 3, 4096])
def test_skew_lookup_of_hot_cold_and_missing_keys(spark, monkeypatch, share):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    keys = [7] * 50 + [k % 20 for k in range(50)] + [None, 99]
    rows = spark.createDataFrame([(k, v) for v, k in enumerate(keys)], "k long, v long")
    table = rows.where("k < 50").groupBy("k").agg(F.count("*").alias("n"), (F.col("k") * 10).alias("x"))
    out = common.skew_lookup(rows, table, "k", "n", len(keys), F.col("v")).collect()
    assert sorted((r["v"], r["k"], r["x"]) for r in out) == [
        (v, k, None if k is None or k >= 50 else k * 10) for v, k in enumerate(keys)
    ]
