"""Queries that SQL can express, against DuckDB on the small tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tspanel.llm import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    want = con.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = catalog.QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())
