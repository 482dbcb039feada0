"""Every registered query equals its DuckDB SQL on sf0.001 (row count,
column names, order-insensitive exact values)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from tallyflow.plans.queries import all_queries
from tools.check_oracle import digest, duck

SF = "/root/testdata/sf0.001"
SQL = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    want = digest([c[0] for c in cur.description], cur.fetchall())
    got = digest(df.columns, rows)
    assert got[:3] == want[:3], (sorted(set(got[3]) - set(want[3]))[:3], sorted(set(want[3]) - set(got[3]))[:3])


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["platform", "minute", "turnover_cents", "turnover"]
    assert df.count() > 0
