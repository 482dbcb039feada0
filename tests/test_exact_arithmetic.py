"""F8 against Python's decimals: any magnitude, no rounded operand."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest

from tallyflow.functions.money import exact_add, exact_div, exact_mul, exact_round, exact_sub


def operands():
    rng = random.Random(13)
    out = [0.1234567891, 1e9, 2e10, 1e-10, 0.0, -0.0, 19.99, 100.0, -7.25, 123456789012345.6, 1.5e-7, 9.007199254740993e15, 0.005, 2.675, 1.0]
    out += [round(rng.uniform(-1e4, 1e4), 2) for _ in range(20)]
    out += [rng.uniform(-1, 1) * 10 ** rng.randint(-12, 15) for _ in range(25)]
    return out


def close(a: Decimal, scale: int) -> float:
    return float(a.quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP))


def test_add_sub_mul(spark):
    values = operands()
    pairs = [(a, b) for a in values for b in values]
    got = spark.createDataFrame(pairs, "a double, b double").select(
        "a", "b", exact_add("a", "b"), exact_sub("a", "b"), exact_mul("a", "b")
    ).collect()
    with localcontext() as c:
        c.prec = 120
        for a, b, add, sub, mul in got:
            x, y = Decimal(repr(a)), Decimal(repr(b))
            assert (add, sub, mul) == (float(x + y), float(x - y), float(x * y)), (a, b)


def test_div_and_round(spark):
    # Divisors of 17 digits far below one ask for more than 38 digits.
    values = [v for v in operands() if abs(v) < 1e6 and (v == 0 or abs(v) >= 1e-3 or v in (1e-10, 1.5e-7))]
    pairs = [(a, b) for a in values for b in values if b != 0]
    got = spark.createDataFrame(pairs, "a double, b double").select("a", "b", exact_div("a", "b"), exact_div("a", "b", 2), exact_round("a", 2)).collect()
    with localcontext() as c:
        c.prec = 120
        for a, b, ten, two, rounded in got:
            x, y = Decimal(repr(a)), Decimal(repr(b))
            assert (ten, two, rounded) == (close(x / y, 10), close(x / y, 2), close(x, 2)), (a, b)


def test_nulls_and_errors(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None)], "a double, b double")
    for row in df.select(exact_add("a", "b"), exact_sub("a", "b"), exact_mul("a", "b"), exact_div("a", "b")).collect():
        assert set(row) == {None}
    for bad in (exact_div("a", "b"), exact_mul("a", "c"), exact_div("d", "e")):
        with pytest.raises(Exception, match="(?i)division by zero|not a number|38"):
            spark.createDataFrame([(1.0, 0.0, float("nan"), 1e300, 1e-300)], "a double, b double, c double, d double, e double").select(bad).collect()
