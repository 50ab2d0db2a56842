"""Query registry shared by the catalogue modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a Spark plan under ``name`` with an optional DuckDB SQL twin."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


def R(cols: str) -> str:
    """SQL select list rounding the listed double columns like ``plans.util.rounded``."""
    return ", ".join(f"{rnd(c)} AS {c}" for c in cols.split())


def rnd(expr: str) -> str:
    """SQL twin of ``plans.util.rounded`` for one double expression."""
    return f"round({expr} + 3.3e-9, 6)"
