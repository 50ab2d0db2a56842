"""Forecast-error aggregate expressions (E-1..E-6).

Two families exist in the reference and are kept apart:
* clamped (E-2, E-3): the denominator is floored at ``eps``;
* masked (E-5): rows whose denominator is ``<= eps`` are left out, all left
  out → NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tspanel.config import EPS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mae(y: Column | str = "y", p: Column | str = "y_pred") -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


def rmse(y: Column | str = "y", p: Column | str = "y_pred") -> Column:
    e = _c(y) - _c(p)
    return F.sqrt(F.avg(e * e))


def mape_clamped(y: Column | str = "y", p: Column | str = "y_pred", eps: float = EPS) -> Column:
    y, p = _c(y), _c(p)
    return F.avg(F.abs((y - p) / F.greatest(F.abs(y), F.lit(eps)))) * F.lit(100.0)


def smape_clamped(y: Column | str = "y", p: Column | str = "y_pred", eps: float = EPS) -> Column:
    y, p = _c(y), _c(p)
    den = F.greatest((F.abs(y) + F.abs(p)) / F.lit(2.0), F.lit(eps))
    return F.avg(F.abs(y - p) / den) * F.lit(100.0)


def mape_masked(y: Column | str = "y", p: Column | str = "y_pred", eps: float = EPS) -> Column:
    y, p = _c(y), _c(p)
    return F.avg(F.when(F.abs(y) > F.lit(eps), F.abs((y - p) / y))) * F.lit(100.0)


def smape_masked(y: Column | str = "y", p: Column | str = "y_pred", eps: float = EPS) -> Column:
    y, p = _c(y), _c(p)
    den = F.abs(y) + F.abs(p)
    return F.avg(F.when(den > F.lit(eps), F.lit(2.0) * F.abs(y - p) / den)) * F.lit(100.0)


def clamped_metrics(y: Column | str = "y", p: Column | str = "y_pred") -> list[Column]:
    """E-1..E-3 as aliased aggregates (mase is added by the caller)."""
    return [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"),
            mape_clamped(y, p).alias("mape"), smape_clamped(y, p).alias("smape")]


def masked_metrics(y: Column | str = "y", p: Column | str = "y_pred") -> list[Column]:
    """E-1 + E-5 as aliased aggregates (pipeline form)."""
    return [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"),
            mape_masked(y, p).alias("mape"), smape_masked(y, p).alias("smape")]
