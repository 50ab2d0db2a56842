"""Forecasters, fleets, anomaly detectors, diagnostics and ML: numpy
re-implementations and invariants (no look-ahead, halo = unbucketed,
ranks are permutations)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import panel_df
from tspanel.config import AnomalyConfig, FeatureConfig
from tspanel.operators import baselines as B
from tspanel.operators import diagnose as D
from tspanel.operators import evaluate as E
from tspanel.operators import windowing as hw
from tspanel.operators.isolation import isolation_forest


def seasonal_rows(n=1440, uid="s", spikes=(), seed=7, start="2024-01-01"):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    y = 20 + 0.002 * t + 4 * np.sin(2 * np.pi * t / 24) + 2 * np.sin(2 * np.pi * t / 168) + rng.normal(0, 0.4, n)
    for k in spikes:
        y[k] += 15.0
    base = pd.Timestamp(start)
    return [(uid, str(base + pd.Timedelta(hours=i)), float(v)) for i, v in enumerate(y)], y


@pytest.fixture(scope="module")
def seasonal(spark):
    rows, y = seasonal_rows()
    rows2, y2 = seasonal_rows(600, "t", seed=9, start="2024-02-03 05:00:00")
    return panel_df(spark, rows + rows2).checkpoint(eager=True), y, y2


def _np_baselines(y, h=24):
    n = len(y)
    scale = np.std(y[24:] - y[:-24])
    swa = []
    for i in range(1, h + 1):
        idx = n - 24 + (i - 1) % 24
        vals = [y[idx - 24 * k] for k in range(7) if 0 <= idx - 24 * k < n]
        swa.append(np.mean(vals))
    return {
        "naive": np.repeat(y[-1], h),
        "seasonal_naive_24": np.tile(y[-24:], 1)[:h],
        "seasonal_naive_168": y[-168:][:h],
        "window_average_168": np.repeat(y[-168:].mean(), h),
        "seasonal_window_average": np.array(swa),
        "drift": y[-1] + (y[-1] - y[0]) / (n - 1) * np.arange(1, h + 1),
    }, scale


def test_baselines_match_numpy(spark, seasonal):
    p, y, _ = seasonal
    cuts = B.backtest_cutoffs(p).filter("unique_id = 's'")
    fc = B.baseline_forecasts(p, cuts).filter("window = 2").toPandas()
    cut = int(cuts.filter("window = 2").first()["cut"])
    expected, scale = _np_baselines(y[:cut])
    for model, vals in expected.items():
        got = fc[fc.model == model].sort_values("horizon")
        np.testing.assert_allclose(got["y_pred"].to_numpy(), vals, rtol=1e-10, err_msg=model)
        np.testing.assert_allclose(got["upper_95"] - got["y_pred"], 1.96 * scale, rtol=1e-8)


def test_backtest_does_not_look_ahead(spark, seasonal):
    p, _, _ = seasonal
    cuts = B.backtest_cutoffs(p)
    first_cut = cuts.filter("window = 1").select("unique_id", F.col("cut").alias("_c"))
    changed = p.join(first_cut, "unique_id").withColumn(
        "y", F.when(F.col("pos") > F.col("_c"), F.col("y") * 3 + 100).otherwise(F.col("y"))).drop("_c")
    a = B.baseline_forecasts(p, cuts).filter("window = 1")
    b = B.baseline_forecasts(changed, cuts).filter("window = 1")
    diff = a.alias("a").join(b.alias("b"), ["unique_id", "window", "cut", "horizon", "model"]).filter(
        F.abs(F.col("a.y_pred") - F.col("b.y_pred")) > 1e-12)
    assert diff.count() == 0


def test_halo_layout_equals_unbucketed(spark, seasonal):
    p, _, _ = seasonal
    w = hw.series_window()
    cols = {"l168": F.lag("y", 168).over(w), "m24": F.avg("y").over(w.rowsBetween(-24, -1)),
            "c": F.sum("y").over(w.rowsBetween(-12, 12))}
    small = hw.rolling(p, cols, behind=168, ahead=12, bucket=200).orderBy("unique_id", "pos").toPandas()
    big = hw.rolling(p, cols, behind=168, ahead=12, bucket=100000).orderBy("unique_id", "pos").toPandas()
    assert len(small) == len(big) == 2040
    for c in cols:
        np.testing.assert_allclose(small[c].to_numpy(dtype=float), big[c].to_numpy(dtype=float), rtol=1e-12, equal_nan=True)


def test_rank_is_permutation(spark, seasonal):
    p, _, _ = seasonal
    from tspanel.plans import pipelines as PL
    _, _, lb = PL.statistical_backtest(p)
    for uid, g in lb.toPandas().groupby("unique_id"):
        assert sorted(g["rank"]) == list(range(1, len(g) + 1))
        assert list(g.sort_values("rank")["smape"]) == sorted(g["smape"])


def test_isolation_forest_finds_planted_spikes(spark):
    spikes = tuple(range(300, 1400, 55))           # 20 spikes
    rows, _ = seasonal_rows(1440, "iso", spikes=spikes)
    p = panel_df(spark, rows)
    scores = isolation_forest(p, AnomalyConfig()).toPandas()
    scores["i"] = scores["pos"].astype(int) - 1
    assert len(scores) == 1440 and not scores[scores.isolation_score.isna()].isolation_anomaly.any()
    scores = scores[scores.isolation_score.notna()]
    assert len(scores) == 1440 - 168                 # rows with complete features
    assert 10 <= int(scores["isolation_anomaly"].sum()) <= 16      # 1 % contamination
    # a spike shows in y at its own row and in lag_1 / rolling stats one row later
    near = scores[scores["i"].isin(set(spikes) | {k + 1 for k in spikes})]
    far = scores[~scores["i"].isin({k + d for k in spikes for d in range(0, 25)})]
    assert near["isolation_score"].mean() > far["isolation_score"].quantile(0.9)
    flagged = set(scores.loc[scores["isolation_anomaly"], "i"])
    assert len(flagged & {k + d for k in spikes for d in range(0, 25)}) >= len(flagged) * 0.7


def test_pacf_durbin_levinson_matches_yule_walker(spark, seasonal):
    p, y, _ = seasonal
    acf = D.acf(p.filter("unique_id = 's'"), 10, None)
    pacf = D.pacf_from_acf(acf).orderBy("lag").toPandas()["pacf"].to_numpy()
    r = acf.orderBy("lag").toPandas()["acf"].to_numpy()
    for k in (1, 2, 5, 10):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(toeplitz, r[1:k + 1])
        assert pacf[k] == pytest.approx(phi[-1], abs=1e-10)
    e = y - y.mean()
    assert r[3] == pytest.approx(np.dot(e[3:], e[:-3]) / np.dot(e, e), rel=1e-10)


def test_stationarity_tests(spark):
    rng = np.random.default_rng(1)
    e = rng.normal(size=3000)
    ar = np.zeros(3000)
    for i in range(1, 3000):
        ar[i] = 0.5 * ar[i - 1] + e[i]
    rw = np.cumsum(e)
    base = pd.Timestamp("2024-01-01")
    rows = [("ar", str(base + pd.Timedelta(hours=i)), float(v)) for i, v in enumerate(ar)]
    rows += [("rw", str(base + pd.Timedelta(hours=i)), float(v)) for i, v in enumerate(rw)]
    out = {r["unique_id"]: r for r in D.stationarity_tests(panel_df(spark, rows), 2000).collect()}
    assert out["ar"]["adf_pvalue"] < 0.01 and out["rw"]["adf_pvalue"] > 0.05
    assert out["rw"]["kpss_pvalue"] == 0.01 and out["ar"]["used_observations"] == 2000
    # ADF statistic equals a direct OLS t-value for the chosen lag
    x = ar[-2000:]
    lag = out["ar"]["adf_usedlag"]
    dx = np.diff(x)
    rows_ = np.arange(lag, len(dx))
    X = np.column_stack([x[rows_]] + [dx[rows_ - j] for j in range(1, lag + 1)] + [np.ones(len(rows_))])
    beta, res, *_ = np.linalg.lstsq(X, dx[rows_], rcond=None)
    sigma2 = np.sum((dx[rows_] - X @ beta) ** 2) / (len(rows_) - X.shape[1])
    t = beta[0] / np.sqrt(sigma2 * np.linalg.inv(X.T @ X)[0, 0])
    assert out["ar"]["adf_statistic"] == pytest.approx(t, rel=1e-8)


def test_decomposition_matches_numpy(spark, seasonal):
    p, y, _ = seasonal
    out = D.decompose(p.filter("unique_id = 's'"), 24, 480).orderBy("pos").toPandas()
    x = y[-480:]
    w = np.r_[0.5, np.ones(23), 0.5] / 24
    trend = np.full(480, np.nan)
    trend[12:-12] = np.convolve(x, w, mode="valid")
    idx = np.arange(480)
    k0, b0 = np.polyfit(idx[12:36], trend[12:36], 1)
    k1, b1 = np.polyfit(idx[480 - 13 - 24:480 - 13], trend[480 - 13 - 24:480 - 13], 1)
    trend[:12] = k0 * idx[:12] + b0
    trend[-12:] = k1 * idx[-12:] + b1
    det = x - trend
    avg = np.array([det[idx % 24 == j].mean() for j in range(24)])
    seas = (avg - avg.mean())[idx % 24]
    np.testing.assert_allclose(out["trend"], trend, rtol=1e-9)
    np.testing.assert_allclose(out["seasonal"], seas, atol=1e-9)
    np.testing.assert_allclose(out["resid"], det - seas, atol=1e-9)


def test_ml_step_features_match_spark_features(spark, seasonal):
    from tspanel.operators import ml as ML
    from tspanel.operators.features import feature_names, forecast_features

    p, _, _ = seasonal
    cfg = FeatureConfig()
    cuts = B.final_cutoffs(p.filter("unique_id = 's'")).withColumn("cut", F.col("cut") - 1)
    state = ML.initial_state(p, cuts, 169).toPandas()
    hist = np.array([np.asarray(state["hist"].iloc[0], dtype=float)])
    ds = pd.Series(pd.to_datetime(state["cut_ds"])) + pd.Timedelta(hours=1)
    x = ML.numpy_features(hist, ds, cfg)[0]
    n = int(cuts.first()["cut"]) + 1
    row = forecast_features(p.filter("unique_id = 's'"), cfg).filter(F.col("pos") == n).toPandas()
    np.testing.assert_allclose(x, row[feature_names(cfg)].to_numpy(dtype=float)[0], rtol=1e-9)


def test_selection_table_and_combine(spark):
    a = spark.createDataFrame([("s", 1, "naive", 1.0, 1.0, 1.0, 5.0, 1.0), ("s", 2, "drift", 1.0, 1.0, 1.0, 7.0, 1.0)],
                              "unique_id string, rank int, model string, mae double, rmse double, mape double, smape double, mase double")
    sel = {r["model"]: r for r in E.selection_table(a).collect()}
    assert sel["naive"]["group"] == "baseline" and sel["naive"]["decision"] == "primary candidate"
    assert sel["drift"]["group"] == "statistical"
    b = a.withColumn("smape", F.col("smape") - 3).withColumn("model", F.concat(F.lit("x_"), "model"))
    comb = E.combine_leaderboards(a.withColumn("group", F.lit("g1")), b.withColumn("group", F.lit("g2")))
    assert [r["model"] for r in comb.orderBy("rank").collect()] == ["x_naive", "x_drift", "naive", "drift"]


def test_short_and_constant_series_do_not_raise(spark):
    """ANSI mode: empty training ranges and constant residuals give NULLs, not errors."""
    from tspanel.operators.prepare import regularize
    from tspanel.plans import pipelines as PL

    rows = [("short", str(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)), float(i % 3)) for i in range(20)]
    rows += [("const", str(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)), 5.0) for i in range(400)]
    p = regularize(panel_df(spark, rows, with_pos=False), 3600)
    cuts = B.pipeline_cutoffs(p)
    assert B.baseline_forecasts(p, cuts).count() > 0
    preds, _, board = PL.pipeline_backtest(p)
    assert board.count() > 0
    tests = D.pipeline_tests(preds).collect()
    assert all(r["statistic"] is None or r["statistic"] == r["statistic"] for r in tests)
    assert B.train_scales(p, cuts).count() == cuts.count()


def test_registered_forecaster_joins_backtest(spark, seasonal):
    from tspanel.plans import pipelines as PL

    p, _, _ = seasonal

    def mean_of_train(panel, cuts):
        means = (panel.join(cuts, "unique_id").filter(F.col("pos") <= F.col("cut"))
                      .groupBy("unique_id", "window", "cut").agg(F.avg("y").alias("y_pred")))
        return means.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(24)))).withColumn("model", F.lit("mean"))

    PL.register_forecaster("mean", mean_of_train)
    try:
        _, _, lb = PL.statistical_backtest(p)
        assert "mean" in {r["model"] for r in lb.collect()}
        assert PL.statistical_forecast(p).filter("model = 'mean'").count() == 48
    finally:
        PL.FORECASTERS.pop("mean")


def test_standalone_forecasters_equal_unified_engine(spark, seasonal):
    p, _, _ = seasonal
    cuts = B.backtest_cutoffs(p)
    unified = {(r["unique_id"], r["window"], r["horizon"], r["model"]): r["y_pred"]
               for r in B.baseline_forecasts(p, cuts, bands=False).collect()}
    single = (B.naive(p, cuts).unionByName(B.seasonal_naive(p, cuts, 24)).unionByName(B.seasonal_naive(p, cuts, 168))
               .unionByName(B.window_average(p, cuts)).unionByName(B.seasonal_window_average(p, cuts))
               .unionByName(B.drift(p, cuts)))
    rows = single.collect()
    assert len(rows) == len(unified)
    for r in rows:
        assert r["y_pred"] == pytest.approx(unified[(r["unique_id"], r["window"], r["horizon"], r["model"])], rel=1e-12)
    pc = B.pipeline_cutoffs(p)
    how = {(r["unique_id"], r["window"], r["horizon"]): r["y_pred"] for r in B.seasonal_how_average(p, pc).collect()}
    eng = B.pipeline_forecasts(p, pc, actuals=False, models=["seasonal_how_average"]).collect()
    assert len(eng) == len(how)
    for r in eng:
        assert r["y_pred"] == pytest.approx(how[(r["unique_id"], r["window"], r["horizon"])], rel=1e-12)


def test_alternate_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 2)) * [1.0, 20.0] + [5.0, -3.0]
    y = x @ [2.0, 0.1] + rng.normal(size=60)
    from pyspark.ml.linalg import Vectors

    from tspanel.operators import ml as ML

    rows = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x.tolist(), y, strict=True)], ["features", "y"])
    got = ML.ALTERNATE_MODELS["ridge_regression"](scale=float(y.std()) / len(y)).fit(rows)
    xc = x - x.mean(axis=0)
    want = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ (y - y.mean()))
    assert np.allclose(got.coefficients.toArray(), want, atol=1e-9)


def test_alternate_presets_build():
    from tspanel.operators import ml as ML

    made = {k: f() for k, f in ML.ALTERNATE_MODELS.items()}
    assert made["boosted_trees"].getMaxIter() == 500 and made["random_forest"].getNumTrees() == 300
    assert not made["ridge_regression"].getStandardization()


def test_direct_window_adds_batches_up_by_cell(spark):
    """Many small Arrow batches make one matrix a partition, and no array of matrices."""
    import numpy as np
    from pyspark.sql import functions as F

    from tests.conftest import panel_df
    from tspanel.operators import baselines as B
    from tspanel.operators import ml as ML

    rng = np.random.default_rng(3)
    y = rng.normal(size=(2, 60)).cumsum(axis=1)
    panel = panel_df(spark, [(f"s{i}", f"2024-01-{1 + t // 24:02d} {t % 24:02d}:00:00", float(y[i, t])) for i in range(2) for t in range(60)])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        out = ML.direct_window_forecasts(panel, B.final_cutoffs(panel), input_size=6, horizon=2)
        plan = out._jdf.queryExecution().toString()
        got = {(r["unique_id"], r["horizon"]): r["y_pred"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "collect_list(xtx" not in plan and "sum(value" in plan
    win = np.concatenate([np.lib.stride_tricks.sliding_window_view(s, 8) for s in y])
    x, t = ML._robust(win[:, :6], win[:, 6:])
    x = np.hstack([x, np.ones((len(x), 1))])
    coef = np.linalg.solve(x.T @ x + np.diag([1.0] * 6 + [0.0]), x.T @ t)
    for i in range(2):
        last = y[i, -6:]
        med = np.median(last)
        mad = np.median(np.abs(last - med))
        want = np.r_[(last - med) / mad, 1.0] @ coef * mad + med
        assert np.allclose([got[f"s{i}", 1], got[f"s{i}", 2]], want, rtol=1e-9)
