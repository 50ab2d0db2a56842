"""Every query with an SQL twin agrees with DuckDB on the sf0.001 tables
(row count, column names, values rounded to 6 digits)."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle_check import canon, duck

ORACLE = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_duckdb(spark, con, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)
