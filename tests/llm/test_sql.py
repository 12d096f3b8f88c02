"""Operators that SQL can express, next to their SQL on the smallest tables."""

import os

import pytest

import compare
from jobstrata.llm import queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(set(queries.ORACLE) - {"op6_url_filters"}))
def test_query(spark, name):
    got, want, _, _ = compare.run_pair(spark, compare.connect(FOLDER), queries.QUERIES[name], queries.ORACLE[name], FOLDER)
    assert got == want and got[1]
