"""Canonical schemas and the required-column check (S-5, U-2)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

PANEL_SCHEMA = T.StructType([
    T.StructField("unique_id", T.StringType(), True),
    T.StructField("ds", T.TimestampType(), True),
    T.StructField("y", T.DoubleType(), True),
])

# Canonical backtest prediction schema shared by every model group.
PREDICTION_COLUMNS = [
    "unique_id", "window", "cutoff", "ds", "horizon", "group", "model", "y", "y_pred",
    "lower_80", "upper_80", "lower_95", "upper_95", "residual",
]

METRIC_COLUMNS = ["mae", "rmse", "mape", "smape", "mase"]


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    """Raise ValueError listing the missing columns (schema only, no job)."""
    missing = sorted(set(columns).difference(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
