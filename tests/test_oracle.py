"""Every query with SQL, value by value against DuckDB."""

import os

import pytest

import oracle
from surveyloom.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR) is None
