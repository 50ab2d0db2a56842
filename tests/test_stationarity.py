"""ADF and KPSS over whole series against plain least squares and plain sums."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tspanel.operators.stationarity import kpss_pvalue, stationarity_tests


def plain_adf(x):
    x = x - x.mean()
    n = len(x)
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    dx = np.diff(x)

    def fit(lag, start):
        t = np.arange(start, len(dx))
        a = np.column_stack([np.ones(len(t)), x[t]] + [dx[t - j] for j in range(1, lag + 1)])
        beta = np.linalg.lstsq(a, dx[t], rcond=None)[0]
        r = dx[t] - a @ beta
        return a, beta, float(r @ r), len(t)

    scores = []
    for lag in range(most + 1):
        a, _, ssr, nobs = fit(lag, most)
        scores.append(nobs * math.log(ssr / nobs) + 2 * a.shape[1])
    lag = int(np.argmin(scores))
    a, beta, ssr, nobs = fit(lag, lag)
    return beta[1] / math.sqrt(ssr / (nobs - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1]), lag


def plain_kpss(x):
    n, e = len(x), x - x.mean()
    products = [float(e[k:] @ e[:n - k]) for k in range(n)]
    few = int(n ** (2 / 9))
    s0 = (products[0] + 2 * sum(products[1:few + 1])) / n
    s1 = 2 * sum(k * products[k] for k in range(1, few + 1)) / n
    lags = min(int(1.1447 * np.cbrt((s1 / s0) ** 2) * np.cbrt(n)), n - 1)
    variance = (products[0] + 2 * sum((1 - k / (lags + 1)) * products[k] for k in range(1, lags + 1))) / n
    return float((np.cumsum(e) ** 2).sum()) / n ** 2 / variance, lags


def series():
    rng = np.random.default_rng(8)
    e = rng.normal(size=9000)
    ar = np.zeros(9000)
    for i in range(2, 9000):
        ar[i] = 0.6 * ar[i - 1] - 0.3 * ar[i - 2] + e[i]
    return {"long": ar, "walk": np.cumsum(e[:1500]), "season": 10 + 3 * np.sin(np.arange(700) * 2 * np.pi / 24) + e[:700],
            "tiny": e[:6], "level": 1e6 + e[:400]}


@pytest.mark.parametrize("bucket", [8192, 64])
def test_equal_to_plain_sums(spark, bucket):
    import pandas as pd

    rows = [(u, 3 * i + 1, float(v)) for u, x in series().items() for i, v in enumerate(x)]     # positions with holes
    rows += [("long", 3 * i + 2, None) for i in range(0, 9000, 7)] + [("flat", i, 2.5) for i in range(1, 60)] + [("one", 1, 1.0), ("none", 1, None)]
    panel = spark.createDataFrame(pd.DataFrame(rows, columns=["unique_id", "pos", "y"]), "unique_id string, pos long, y double")
    panel = panel.withColumn("y", F.when(~F.isnan("y"), F.col("y")))
    got = {r["unique_id"]: r for r in stationarity_tests(panel, bucket=bucket).collect()}
    assert set(got) == {*series(), "flat", "one"}
    for u, x in series().items():
        stat, lag = plain_adf(x)
        assert got[u]["used_observations"] == len(x)
        if u != "tiny":
            assert got[u]["adf_usedlag"] == lag and got[u]["adf_statistic"] == pytest.approx(stat, rel=1e-6)
        want, lags = plain_kpss(x)
        assert got[u]["kpss_lags"] == lags and got[u]["kpss_statistic"] == pytest.approx(want, rel=1e-7)
    assert all(got["flat"][c] is None for c in ("adf_statistic", "kpss_statistic", "kpss_pvalue", "kpss_lags"))
    assert got["one"]["adf_statistic"] is None


def test_the_last_values_only(spark):
    x = series()["walk"]
    panel = spark.createDataFrame([("a", i + 1, float(v)) for i, v in enumerate(x)], "unique_id string, pos long, y double")
    row = stationarity_tests(panel, 500).first()
    assert row["used_observations"] == 500 and row["kpss_statistic"] == pytest.approx(plain_kpss(x[-500:])[0], rel=1e-8)


def test_kpss_p_values(spark):
    stats = [0.1, 0.347, 0.405, 0.6, 0.739, 6.956163189375577, None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in stats], "s double").select(kpss_pvalue(F.col("s"))).collect()]
    want = [0.1, 0.1, 0.075, 0.025 - 0.026 * 0.015 / 0.165, 0.01, 0.01]
    assert got[-1] is None and got[:-1] == pytest.approx(want)
