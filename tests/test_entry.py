"""Driver contract: entry(), queries(), oracle_sql()."""

from __future__ import annotations

import __spark_entry__ as entry


def test_entry_returns_leaderboard(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert set(df.columns) == {"unique_id", "rank", "model", "mae", "rmse", "mape", "smape", "mase"}


def test_every_oracle_has_a_query():
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 60


def test_queries_do_not_filter_rows_to_stay_cheap():
    for sql in entry.oracle_sql().values():
        assert " limit " not in sql.lower()
