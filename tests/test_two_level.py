"""Two-level ordered operators against brute force, with a hot key that
holds a third of all rows and blocks small enough to split it."""

from __future__ import annotations

import numpy as np
import pandas as pd

from tallyflow.operators import previous_value, running_aggregate
from tallyflow.operators.windows import island_totals


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))
    pdf = pd.DataFrame(
        {"k": key.astype("int64"), "t": rng.permutation(n).astype("int64"), "v": rng.integers(0, 5, n).astype("int64")}
    )
    return pdf, spark.createDataFrame(pdf)


def test_running_sum_and_max(spark):
    pdf, df = _frame(spark)
    got = running_aggregate(df, "t", ["v"], by=("k",), block=37, suffix="_s").toPandas()
    exp = pdf.sort_values("t").assign(v_s=lambda d: d.groupby("k")["v"].cumsum())
    m = got.merge(exp, on=["k", "t"], suffixes=("", "_e"))
    assert len(m) == len(pdf) and (m["v_s"] == m["v_s_e"]).all()
    got = running_aggregate(df, "t", ["v"], block=50, how="max", suffix="_m").toPandas()
    exp = pdf.sort_values("t").assign(v_m=lambda d: d["v"].cummax())
    m = got.merge(exp, on=["k", "t"], suffixes=("", "_e"))
    assert (m["v_m"] == m["v_m_e"]).all()


def test_previous_value_hot_key(spark):
    pdf, df = _frame(spark)
    got = previous_value(df, ["k"], "t", "v", "prev", block=16).toPandas()
    exp = pdf.sort_values("t").assign(prev=lambda d: d.groupby("k")["v"].shift(1))
    m = got.merge(exp, on=["k", "t"], suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert ((m["prev"] == m["prev_e"]) | (m["prev"].isna() & m["prev_e"].isna())).all()


def test_island_totals(spark):
    minutes = [0, 1, 2, 5, 6, 9, 10, 11, 12]
    pdf = pd.DataFrame({"device": [0] * len(minutes), "minute": minutes, "cents": [1, 2, 3, 4, 5, 6, 7, 8, 9]})
    got = island_totals(spark.createDataFrame(pdf), "device").orderBy("minute").toPandas()
    assert got["run_cents"].tolist() == [1, 3, 6, 4, 9, 6, 13, 21, 30]


def test_rows_with_null_keys_or_order_values_stay(spark):
    from tallyflow.operators import changed_payments
    from tallyflow.operators.windows import running_aggregate

    schema = "arrival long, order_id long, minute long, amount_cents long, pay_source int, pay_platform int"
    rows = [(1, 1, 5, 100, 0, 0), (2, None, 5, 200, 0, 0), (3, None, 5, 300, 0, 0), (None, 1, 5, 400, 0, 0), (4, None, 5, 300, 0, 0)]
    got = changed_payments(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.amount_cents for r in got) == [100, 200, 300, 400]
    total = running_aggregate(spark.createDataFrame(rows, schema), "arrival", ["amount_cents"], suffix="_run", block=2)
    assert sorted((r.amount_cents, r.amount_cents_run) for r in total.collect()) == [
        (100, 500), (200, 700), (300, 1000), (300, 1300), (400, 400)
    ]
