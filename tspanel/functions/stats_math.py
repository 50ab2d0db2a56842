"""Distribution tails used by the diagnostic tests.

Degrees of freedom are counts (of rows, of lags), so both tails are finite sums: integrating
the density of Student's t in the angle ``atan(t / sqrt(df))``, or that of chi-squared in ``x / 2``,
by parts lowers the degrees of freedom by two at each step, down to 1 or 2. They are
applied to one-row-per-series statistics inside pandas UDFs, so no series data passes through the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _count(df: float) -> int:
    if df != int(df):
        raise ValueError(f"degrees of freedom must be whole, not {df}")
    return int(df)


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) of chi-squared: the terms half^a e^-half / gamma(a + 1) for a = df/2 - 1, df/2 - 2, ... (and erfc for odd df)."""
    if x is None or df is None or not np.isfinite(x) or df <= 0:
        return float("nan")
    df = _count(df)
    if x <= 0:
        return 1.0
    half, odd = x / 2.0, df % 2
    powers = (i + odd / 2.0 for i in range((df - odd) // 2))
    total = math.fsum(math.exp(a * math.log(half) - half - math.lgamma(a + 1.0)) for a in powers)
    return min(1.0, total + (math.erfc(math.sqrt(half)) if odd else 0.0))


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > t) of Student's t."""
    if t is None or df is None or not np.isfinite(t) or df <= 0:
        return float("nan")
    df = _count(df)
    odd, angle = df % 2, math.atan(abs(t) / math.sqrt(df))
    step, terms = math.cos(angle) if odd else 1.0, []
    for power in range(1 + odd, df, 2):          # the term of cos^(power - 1)
        terms.append(step)
        step *= power / (power + 1.0) * math.cos(angle) ** 2
    inside = math.sin(angle) * math.fsum(terms)
    return max(0.0, 1.0 - ((angle + inside) * 2.0 / math.pi if odd else inside))


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


# MacKinnon (1994) approximate p-value polynomials for the ADF
# test with a constant, one regressor: small-tau and large-tau coefficients,
# and the tau range where the approximation is clipped to 0 / 1.
ADF_TAU_MIN, ADF_TAU_MAX, ADF_TAU_STAR = -18.83, 2.74, -1.61
ADF_SMALL = (2.1659, 1.4412, 0.038269)
ADF_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)


def adf_pvalue(tau: float) -> float:
    if tau is None or not np.isfinite(tau):
        return float("nan")
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    coef = ADF_SMALL if tau <= ADF_TAU_STAR else ADF_LARGE
    return norm_cdf(sum(c * tau ** i for i, c in enumerate(coef)))


# KPSS level-stationarity critical values and their p-values.
KPSS_CRIT = (0.347, 0.463, 0.574, 0.739)
KPSS_P = (0.10, 0.05, 0.025, 0.01)


# ---------------------------------------------------------------- vectorised column functions

def _vec(fn, *cols):
    @F.pandas_udf(T.DoubleType())
    def udf(*series: pd.Series) -> pd.Series:
        frame = pd.concat(series, axis=1)
        return pd.Series([fn(*(None if pd.isna(v) else float(v) for v in row)) for row in frame.itertuples(index=False)],
                         dtype="float64")
    return udf(*cols)


def chi2_sf_col(x, df):
    return _vec(lambda a, b: float("nan") if a is None or b is None else chi2_sf(a, b), x, df)


def t_two_sided_col(t, df):
    return _vec(lambda a, b: float("nan") if a is None or b is None else t_two_sided(a, b), t, df)


def chi2_sf_even_expr(x, df_even: int):
    """Closed form for an even number of degrees of freedom (pure SQL):
    ``exp(-x/2) · Σ_{j<df/2} (x/2)^j / j!``."""
    half = x / F.lit(2.0)
    total = F.lit(0.0)
    for j in range(df_even // 2):
        total = total + F.pow(half, F.lit(float(j))) / F.lit(float(math.factorial(j)))
    return F.exp(-half) * total
