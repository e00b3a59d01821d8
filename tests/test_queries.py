"""Every registered query against its SQL on the smallest tables, and its plan against cross joins."""

import os

import pytest

from catalog import ORACLES, QUERIES
from tools.compare import canonical, database

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    cur = con.execute(ORACLES[name])
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    assert canonical(df.columns, rows) == want
