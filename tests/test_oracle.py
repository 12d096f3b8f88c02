"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import compare
from jobstrata.checks import REGISTRY

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


def _scales(df):
    """No all-with-all join, no row-at-a-time Python, no group collected into one Python call."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert bad not in plan


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    fn, sql = REGISTRY[name]
    if sql is None:
        assert fn(spark, FOLDER).columns
        return
    got, want, _, _ = compare.run_pair(spark, con, fn, sql, FOLDER, inspect=_scales)
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()
