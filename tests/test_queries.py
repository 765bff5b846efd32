"""Registered queries against DuckDB on the smallest data;
`python -m harness.check` does the same for any data folder."""

import os

import pytest

from harness import oracle, registry
from harness.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
NAMES = list(registry.queries())

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not mounted")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_matches_duckdb(spark, con, name):
    text, _, ok = compare(spark, con, registry.queries()[name], oracle.oracle_sql().get(name), FOLDER)
    assert ok, text


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
