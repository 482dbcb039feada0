"""Plan properties that matter at scale, checked on the planned physical
plans of the registered batch queries (sf0.001)."""

from __future__ import annotations

import re

import pytest

from tallyflow.plans.queries import BATCH_QUERIES, all_queries

SF = "/root/testdata/sf0.001"


def _plan(spark, name: str) -> str:
    return all_queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_pair_joins_and_no_python(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas", plan)


def test_flagship_moves_payments_once_and_prunes_columns(spark):
    plan = _plan(spark, "platform_minute_turnover")
    # One shuffle of the payments (on order_id), one of the orders (J2), one
    # of the per-(platform, minute) partial sums.
    assert plan.count("REPARTITION_BY_COL") == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3
    lineitem = re.search(r"FileScan parquet [\w.]*\[([^\]]*)\][^\n]*lineitem", plan)
    assert lineitem and len(lineitem.group(1).split(",")) == 5


def test_ordered_operators_never_window_over_all_rows(spark):
    # The only single-partition exchanges sit over one-row-per-block tables
    # built from the checkpointed minute table, not over the payments scan.
    plan = _plan(spark, "cumulative_turnover")
    assert "FileScan parquet" not in plan
    assert plan.count("Exchange SinglePartition") <= 1
