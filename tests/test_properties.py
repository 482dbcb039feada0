"""Property checks (hypothesis): A1 is a distinct sum, so replaying or
reordering the feed must not change it, and it must equal a brute-force
computation in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyflow.plans.metrics import platform_turnover

PAY = st.tuples(
    st.integers(1, 4),  # order id
    st.integers(1, 5000),  # cents
    st.integers(0, 3),  # source
    st.integers(0, 1),  # device
    st.integers(0, 5),  # minute
)
ORD = st.tuples(st.integers(1, 4), st.integers(0, 1))  # order id, platform
SCHEMA_P = "arrival long, order_id long, pay_amount double, pay_source int, pay_platform int, create_time_ms long"
SCHEMA_O = "arrival long, order_id long, platform int"


def brute(pays, orders):
    first = {}
    for arrival, (oid, plat) in enumerate(orders):
        first.setdefault(oid, plat)
    out = defaultdict(int)
    for oid, cents, _src, _dev, minute in set(pays):
        if oid in first:
            out[(first[oid], minute)] += cents
    return dict(out)


def run(spark, pays, orders):
    p = spark.createDataFrame(
        [(i, oid, cents / 100, src, dev, minute * 60_000 + 7) for i, (oid, cents, src, dev, minute) in enumerate(pays)],
        SCHEMA_P,
    )
    o = spark.createDataFrame([(i, oid, plat) for i, (oid, plat) in enumerate(orders)], SCHEMA_O)
    return {(r.platform, r.minute): r.turnover_cents for r in platform_turnover(p, o).collect()}


@settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(PAY, min_size=1, max_size=25), st.lists(ORD, min_size=1, max_size=6), st.randoms())
def test_turnover_is_replay_and_order_invariant(spark, pays, orders, rnd: random.Random):
    expected = brute(pays, orders)
    replay = pays + rnd.sample(pays, k=min(len(pays), 10))
    rnd.shuffle(replay)
    assert run(spark, pays, orders) == expected
    assert run(spark, replay, orders) == expected
