"""Scalar functions: exact decimal arithmetic, cents, minute, keys, codes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyflow.functions import (
    device_label,
    exact_add,
    exact_div,
    exact_mul,
    exact_round,
    exact_sub,
    from_cents,
    minute_epoch_seconds,
    minute_index,
    pay_source_label,
    platform_name,
    result_key,
    to_cents,
)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_exact_arithmetic(spark):
    r = one(
        spark,
        exact_add(F.lit(0.1), F.lit(0.2)).alias("a"),
        exact_sub(F.lit(1.0), F.lit(0.9)).alias("s"),
        exact_mul(F.lit(4.015), F.lit(100.0)).alias("m"),
        exact_div(F.lit(1.0), F.lit(3.0), 2).alias("d1"),
        exact_div(F.lit(2.0), F.lit(3.0)).alias("d2"),
        exact_round(F.lit(2.345), 2).alias("r1"),
        exact_round(F.lit(-2.345), 2).alias("r2"),
    )
    assert (r.a, r.s, r.m) == (0.3, 0.1, 401.5)
    assert (r.d1, r.d2) == (0.33, 0.6666666667)
    assert (r.r1, r.r2) == (2.35, -2.35)


def test_negative_scale_rejected():
    with pytest.raises(ValueError):
        exact_div("a", "b", -1)
    with pytest.raises(ValueError):
        exact_round("a", -1)


def test_cents_minute_and_keys(spark):
    r = one(
        spark,
        to_cents(F.lit(0.29)).alias("e"),
        to_cents(F.lit(0.29), "truncate").alias("t"),
        from_cents(F.lit(1999)).alias("m"),
        minute_index(F.lit(1467849659999)).alias("mi"),
        minute_epoch_seconds(F.lit(24464160)).alias("s"),
        result_key("ratio_", "t", F.lit(1467849600)).alias("k"),
    )
    assert (r.e, r.t, r.m, r.mi, r.s, r.k) == (29, 28, 19.99, 24464160, 1467849600, "ratio_t_1467849600")


def test_labels(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,), (7,)], "c int").select(
        pay_source_label("c").alias("s"), device_label("c").alias("d"), platform_name("c").alias("p")
    ).collect()
    assert [r.s for r in rows] == ["alipay", "voucher", "unionpay", "other", None]
    assert [r.d for r in rows] == ["pc", "wireless", "wireless", "wireless", "wireless"]
    assert [r.p for r in rows] == ["taobao", "tmall", "tmall", "tmall", "tmall"]


def test_exact_division_by_zero_raises(spark):
    from pyspark.errors import ArithmeticException

    with pytest.raises(ArithmeticException):
        one(spark, exact_div(F.lit(1.0), F.lit(0.0)).alias("d"))
