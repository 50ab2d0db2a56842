"""Fleets against plain recursions, in one block and in many; failures stay with their model."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tspanel.operators import fleet as FL
from tspanel.operators import recurrence as R


def plain_smoothing(y, m, a, b, g, trend, season):
    """Sum of squares from the second season on, level, slope and seasonal terms by the textbook recursion."""
    level = y[:m].mean() if season else y[0]
    slope = ((y[m:2 * m].mean() - y[:m].mean()) / m if season else y[1] - y[0]) if trend else 0.0
    terms, sse = (y[:m] - level) if season else np.zeros(m), 0.0
    for t in range(m if season else 1, len(y)):
        old = terms[t % m]
        if t >= m:
            sse += (y[t] - level - slope - old) ** 2
        new = a * (y[t] - old) + (1 - a) * (level + slope)
        if season:
            terms[t % m] = g * (y[t] - level - slope) + (1 - g) * old
        slope = b * (new - level) + (1 - b) * slope if trend else 0.0
        level = new
    return sse, level, slope, terms


def plain_theta(y, m, kind, a):
    n, index = len(y), np.zeros(m)
    w = np.r_[0.5, np.ones(m - 1), 0.5] / m
    trend = np.convolve(y, w, mode="valid")
    inner = np.arange(m // 2, n - m // 2)
    if kind == "additive":
        index = np.array([(y[inner] - trend)[inner % m == j].mean() for j in range(m)])
        index -= index.mean()
    if kind == "multiplicative":
        index = np.array([(y[inner] / trend)[inner % m == j].mean() for j in range(m)])
        index /= index.mean()
    phase = index[np.arange(n) % m]
    adj = y / phase if kind == "multiplicative" else y - phase
    scale = phase if kind == "multiplicative" else np.ones(n)
    level, sse = adj[0], 0.0
    for t in range(1, n):
        sse += ((adj[t] - level) * scale[t]) ** 2
        level += a * (adj[t] - level)
    return sse, level, np.polyfit(np.arange(n), adj, 1)[0], index


def plain_arima(y, phi, theta):
    w, e, sse = np.diff(y), 0.0, 0.0
    for t in range(1, len(w)):
        e = w[t] - phi * w[t - 1] - theta * e
        sse += e * e
    return sse, e


def series(n, seed=3, m=24):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 100 + 0.02 * t + 8 * np.sin(2 * np.pi * t / m) + np.cumsum(rng.normal(0, 0.2, n)) + rng.normal(0, 1, n)


def frame(spark, data):
    rows = [(uid, i + 1, None if np.isnan(v) else float(v)) for uid, y in data.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "unique_id string, pos long, y double")


def cutoffs(spark, rows):
    return spark.createDataFrame(rows, "unique_id string, window int, cut long")


DATA = {"a": series(500), "b": series(500, 8) - 104.0}
CUTS = [("a", 1, 333), ("a", 2, 500), ("b", 1, 96), ("b", 2, 97), ("b", 3, 449)]


@pytest.fixture(scope="module")
def fitted(spark):
    """Many blocks (the smallest of four seasons) and one block."""
    panel, cuts = frame(spark, DATA), cutoffs(spark, CUTS)
    return [FL.fit_specifications(panel, cuts, bucket=b).toPandas().sort_values(["unique_id", "window", "spec"]).reset_index(drop=True) for b in (96, 8192)]


def test_blocks_do_not_change_the_fit(fitted):
    many, one = fitted
    assert len(many) == len(one) == len(CUTS) * 11
    assert many["error"].fillna("").tolist() == one["error"].fillna("").tolist()
    ok = one["error"].isna()
    np.testing.assert_allclose(many.loc[ok, "sse"].astype(float), one.loc[ok, "sse"].astype(float), rtol=1e-9)
    np.testing.assert_allclose(np.vstack(many.loc[ok, "params"]), np.vstack(one.loc[ok, "params"]), atol=1e-12)
    np.testing.assert_allclose(np.vstack(many.loc[ok, "preds"]), np.vstack(one.loc[ok, "preds"]), rtol=1e-9, atol=1e-9)


def test_states_equal_plain_recursions(fitted):
    i = np.arange(1, 25)
    for r in fitted[0][fitted[0]["error"].isna()].itertuples():
        y, p = DATA[r.unique_id][:r.cut], r.params
        if r.spec in FL.ETS:
            trend, season = FL.ETS[r.spec]
            sse, level, slope, terms = plain_smoothing(y, 24, p[0], p[1], p[2], trend, season)
            told = level + i * slope + (terms[(r.cut + i - 1) % 24] if season else 0)
        elif r.spec in FL.THETA:
            sse, level, slope, index = plain_theta(y, 24, FL.THETA[r.spec], p[0])
            told = level + slope / 2 * (i - 1 + (1 - (1 - p[0]) ** r.cut) / p[0])
            at = index[(r.cut + i - 1) % 24]
            told = told * at if r.spec == 6 else told + at
        else:
            sse, e = plain_arima(y, p[0], p[1])
            steps = [p[0] * (y[-1] - y[-2]) + p[1] * e]
            for _ in i[1:]:
                steps.append(p[0] * steps[-1])
            told = y[-1] + np.cumsum(steps)
        assert r.sse == pytest.approx(sse, rel=1e-8), r
        np.testing.assert_allclose(r.preds, told, rtol=1e-8, atol=1e-8, err_msg=str(r))


def test_refinement_comes_close_to_a_dense_grid(fitted):
    rows = fitted[0].set_index(["unique_id", "window", "spec"])
    y = DATA["a"]
    dense = min(plain_smoothing(y, 24, a, 0, 0, False, False)[0] for a in np.linspace(0.001, 0.999, 200))
    assert rows.loc[("a", 2, 0), "sse"] <= dense * 1.001
    dense = min(plain_arima(y, f, t)[0] for f, t in itertools.product(np.linspace(-0.95, 0.95, 39), repeat=2))
    assert rows.loc[("a", 2, 10), "sse"] <= dense * 1.001
    dense = min(plain_smoothing(y, 24, a, b, g, True, True)[0]
                for a, b, g in itertools.product(np.linspace(0.02, 0.98, 9), np.linspace(0, 0.5, 6), np.linspace(0, 0.9, 7)))
    assert rows.loc[("a", 2, 3), "sse"] <= dense * 1.001


def test_bands_follow_the_simulated_error(spark):
    """Variance factors of the full smoothing model against its own simulated future."""
    p, rng = np.array([3, 0, 0.4, 0.3, 0.2, 0.0, *np.zeros(24)]), np.random.default_rng(5)
    _, factor, _, _ = FL._forecast(3, p, np.zeros(26), np.zeros(2), 48, 24, 30)
    e, s = rng.normal(size=(20000, 30)), np.zeros((26, 20000))
    for t in range(30):
        row = 2 + t % 24
        value = s[0] + s[1] + s[row] + e[:, t]
        assert np.var(value) == pytest.approx(factor[t], rel=0.06)
        s[0] += s[1] + 0.4 * e[:, t]
        s[1] += 0.4 * 0.3 * e[:, t]
        s[row] += 0.2 * e[:, t]


def test_composition_is_the_sweep(spark):
    rng = np.random.default_rng(1)
    w, phi, theta = rng.normal(size=40), np.array([0.3, -0.8]), np.array([0.5, 0.9])
    before = np.r_[0.0, w[:-1]]
    whole = list(R.residuals(w, before, phi, theta, np.zeros((1, 2, 1)), 0, [40]))[0]
    left = list(R.residuals(w[:15], before[:15], phi, theta, np.zeros((1, 2, 1)), 0, [15]))[0]
    right = list(R.residuals(w[15:], before[15:], phi, theta, R.unknown(1, 2), 0, [25]))[0]
    for k in range(2):
        state, sse = R.advance(left[1][k, :, -1], left[2][k, -1, -1], right[1][k, :, :-1], right[1][k, :, -1], right[2][k, :-1, :-1], right[2][k, -1])
        assert state[0] == pytest.approx(whole[1][k, 0, 0]) and sse == pytest.approx(whole[2][k, 0, 0])


def test_old_rows_count(spark):
    """A change in the first rows reaches the fit of the last window: no history is cut off."""
    y = series(400)
    changed = y.copy()
    changed[:48] += 30.0
    p = frame(spark, {"x": y, "z": changed})
    got = FL.fit_specifications(p, cutoffs(spark, [("x", 1, 400), ("z", 1, 400)]), specs=(3, 10), bucket=96).toPandas().set_index(["unique_id", "spec"])
    assert got.loc[("z", 3), "sse"] != got.loc[("x", 3), "sse"] and got.loc[("z", 10), "sse"] != got.loc[("x", 10), "sse"]


def test_fleet_rows_and_failures(spark):
    hole = series(200)
    hole[150] = np.nan
    p = frame(spark, {"short": np.array([1.0, 2.0, 3.0]), "flat": np.full(120, 7.0), "hole": hole})
    got = FL.fleet_forecasts(p, cutoffs(spark, [("short", 1, 3), ("flat", 1, 120), ("hole", 1, 120), ("hole", 2, 200)])).toPandas()
    assert len(got) == 4 * 6 * 24
    by = got.groupby(["unique_id", "window"])
    assert by.get_group(("short", 1))["error"].notna().all() and by.get_group(("short", 1))["y_pred"].isna().all()
    assert by.get_group(("hole", 2))["error"].str.contains("missing").all()
    for key in (("flat", 1), ("hole", 1)):
        assert by.get_group(key)["error"].isna().all() and by.get_group(key)["y_pred"].notna().all(), key
    np.testing.assert_allclose(by.get_group(("flat", 1))["y_pred"], 7.0, atol=1e-9)


def test_fleet_is_better_than_naive_and_bands_hold(spark):
    y = series(740, 4)
    got = FL.fleet_forecasts(frame(spark, {"s": y}), cutoffs(spark, [("s", 1, 716)]))
    pdf = got.toPandas()
    naive = float(np.mean(np.abs(y[715] - y[716:])))
    mae = {m: float(np.mean(np.abs(g.sort_values("horizon")["y_pred"].to_numpy() - y[716:]))) for m, g in pdf.groupby("model")}
    assert set(mae) == set(FL.FLEET_MODELS) and mae["manual_ets_additive"] < naive and mae["auto_ets"] < naive and mae["manual_theta_24"] < naive
    auto = pdf[pdf["model"].str.startswith("auto")]
    assert (auto["upper_95"] > auto["upper_80"]).all() and (auto["lower_80"] > auto["lower_95"]).all()
    assert pdf[pdf["model"].str.startswith("manual")]["upper_80"].isna().all()
    assert got.where(F.col("horizon") > 24).count() == 0


def test_empty_panel(spark):
    empty = spark.createDataFrame([], "unique_id string, pos long, y double")
    assert isinstance(FL.fleet_forecasts(empty, cutoffs(spark, [])).toPandas(), pd.DataFrame)
