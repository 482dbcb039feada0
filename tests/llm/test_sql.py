"""Operators with SQL: the registered query equals it on sf0.001."""

from __future__ import annotations

import pytest

from tallyflow.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import digest, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(ORACLE_SQL[name])
    want = digest([c[0] for c in cur.description], cur.fetchall())
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    assert got[:3] == want[:3]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
