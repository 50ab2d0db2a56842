"""Queries: model fleets, isolation forest, MLlib models, diagnostics on series.

Queries without an SQL twin are rows-only in the driver; their numerics are
checked by pytest against numpy re-implementations and published goldens.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tspanel.config import AnomalyConfig, BacktestConfig
from tspanel.operators import anomaly as N
from tspanel.operators import baselines as B
from tspanel.operators import diagnose as D
from tspanel.operators import evaluate as E
from tspanel.operators import fleet as FL
from tspanel.operators import ml as ML
from tspanel.operators.isolation import isolation_forest
from tspanel.plans import pipelines as PL
from tspanel.plans.registry import register, rnd
from tspanel.plans.util import rounded
from tspanel.sources.panels import panel_sql, prepared_panel


def _h(spark, sf):
    return prepared_panel(spark, sf, "H")


def _cuts(p):
    c = BacktestConfig()
    return B.backtest_cutoffs(p, c.horizon, c.n_windows, c.step, c.min_history)


# ---------------------------------------------------------------- F-13..F-17

@register("fleet_backtest_forecasts")
def q_fleet(spark, sf):
    """Holt-Winters, Theta, ARIMA and the auto_* fleets per (series, window)."""
    p = _h(spark, sf)
    return rounded(FL.fleet_forecasts(p, _cuts(p)))


@register("statistical_leaderboard_full")
def q_stat_full(spark, sf):
    """PIPE-3: the 12-model statistical leaderboard (baselines + fleets)."""
    p = _h(spark, sf)
    _, _, lb = PL.statistical_backtest(p, extra=lambda pp, cc: FL.fleet_forecasts(pp, cc).drop("error"))
    return rounded(E.selection_table(lb))


@register("statistical_forecast_full")
def q_stat_fc_full(spark, sf):
    """F-12 with every statistical model, 80/95 bands where the model has them."""
    p = _h(spark, sf)
    fc = PL.statistical_forecast(p, extra=lambda pp, cc: FL.fleet_forecasts(pp, cc).drop("error"))
    return rounded(fc.select("unique_id", "ds", "horizon", "model", "y_pred", "lower_80", "upper_80",
                             "lower_95", "upper_95"))


# ---------------------------------------------------------------- N-4, N-5, A-10

@register("anomaly_isolation_forest")
def q_iforest(spark, sf):
    return rounded(isolation_forest(_h(spark, sf)))


@register("anomaly_combined")
def q_anomaly_all(spark, sf):
    """N-5 with all three detectors (votes and selected flag)."""
    p = _h(spark, sf)
    out = N.combine(p, AnomalyConfig(), isolation=isolation_forest(p))
    return rounded(out.withColumn("anomaly_votes", F.col("anomaly_votes").cast("bigint")))


@register("anomaly_summary")
def q_anomaly_summary(spark, sf):
    p = _h(spark, sf)
    return N.summary(N.combine(p, AnomalyConfig(), isolation=isolation_forest(p)))


# ---------------------------------------------------------------- G-1..G-5, F-18..F-20

ML_MODELS = ["ridge_regression", "random_forest", "hist_gradient_boosting"]


def _ml_preds(spark, sf, models):
    p = _h(spark, sf)
    cuts = _cuts(p)
    fc = ML.ml_forecasts(p, cuts, models)
    preds = PL.with_cutoff_ds(B.attach_actuals(fc, p), p).withColumn("group", F.lit("ML"))
    return p, cuts, preds


@register("ml_backtest_predictions")
def q_ml_preds(spark, sf):
    """Ridge and random forest: per-window MLlib fits, recursive 24 steps."""
    _, _, preds = _ml_preds(spark, sf, ["ridge_regression", "random_forest"])
    return rounded(preds.select("unique_id", "ds", "window", "horizon", "group", "model", "y", "y_pred"))


@register("ml_boosting_backtest_predictions")
def q_ml_gbt(spark, sf):
    """Gradient-boosted trees (250 rounds, step 0.05), recursive 24 steps."""
    _, _, preds = _ml_preds(spark, sf, ["hist_gradient_boosting"])
    return rounded(preds.select("unique_id", "ds", "window", "horizon", "group", "model", "y", "y_pred"))


@register("ml_leaderboard")
def q_ml_lb(spark, sf):
    """E-7 / E-8 for the ML group (in-sample MASE scale per window)."""
    p, cuts, preds = _ml_preds(spark, sf, ML_MODELS)
    bw = E.metrics_by_window(preds.withColumn("residual", F.col("y") - F.col("y_pred")),
                             E.insample_scale(p, cuts, 24), "clamped")
    return rounded(E.selection_table(E.leaderboard(bw), group="ML", best_label="primary ML candidate"))


@register("ml_final_forecast")
def q_ml_final(spark, sf):
    """F-12 of the ML group: fit on the whole series, 24 future steps."""
    p = _h(spark, sf)
    cuts = B.final_cutoffs(p)
    fc = ML.ml_forecasts(p, cuts, ML_MODELS)
    fc = B.future_timestamps(fc, p, 3600).withColumn("group", F.lit("ML"))
    return rounded(fc.select("unique_id", "ds", "horizon", "group", "model", "y_pred"))


# ---------------------------------------------------------------- F-21, F-22, E-9

@register("direct_window_backtest")
def q_direct(spark, sf):
    """Direct 24-output model on robust-scaled 168-step windows (network block re-aimed)."""
    p = _h(spark, sf)
    cuts = _cuts(p)
    fc = ML.direct_window_forecasts(p, cuts)
    preds = PL.with_cutoff_ds(B.attach_actuals(fc, p), p).withColumn("group", F.lit("DL"))
    return rounded(preds.select("unique_id", "ds", "window", "horizon", "group", "model", "y", "y_pred", "cutoff"))


@register("direct_final_forecast")
def q_direct_final(spark, sf):
    """F-12 of the direct-window group: fit on the whole series, 24 future steps."""
    p = _h(spark, sf)
    fc = B.future_timestamps(ML.direct_window_forecasts(p, B.final_cutoffs(p)), p, 3600).withColumn("group", F.lit("DL"))
    return rounded(fc.select("unique_id", "ds", "horizon", "group", "model", "y_pred"))


@register("data_driven_leaderboard")
def q_data_driven(spark, sf):
    """E-9: ML and direct-window leaderboards combined and re-ranked."""
    p, cuts, preds = _ml_preds(spark, sf, ML_MODELS)
    scale = E.insample_scale(p, cuts, 24)
    ml_lb = E.leaderboard(E.metrics_by_window(preds, scale, "clamped")).withColumn("group", F.lit("ML"))
    d = B.attach_actuals(ML.direct_window_forecasts(p, cuts), p)
    dl_lb = E.leaderboard(E.metrics_by_window(d, scale, "clamped")).withColumn("group", F.lit("DL"))
    return rounded(E.combine_leaderboards(ml_lb, dl_lb))


# ---------------------------------------------------------------- D-7..D-10, K-1

@register("acf", f"""
WITH {panel_sql('H')},
sl AS (SELECT p.unique_id, p.pos, p.y FROM panel p JOIN (SELECT unique_id, max(pos) AS n FROM panel WHERE y IS NOT NULL GROUP BY 1) l
       USING (unique_id) WHERE p.y IS NOT NULL),
s AS (SELECT unique_id, pos, y - avg(y) OVER (PARTITION BY unique_id) AS e FROM sl),
c AS (SELECT a.unique_id, k.k AS lag, sum(a.e * b.e) AS s FROM s a CROSS JOIN generate_series(0, 72) AS k(k)
      JOIN s b ON b.unique_id = a.unique_id AND b.pos = a.pos - k.k GROUP BY 1, 2)
SELECT c.unique_id, CAST(c.lag AS BIGINT) AS lag, {rnd('c.s / z.c0')} AS acf
FROM c JOIN (SELECT unique_id, s AS c0 FROM c WHERE lag = 0) z USING (unique_id)""")
def q_acf(spark, sf):
    """D-7: biased ACF to lag 72 on the last 10,000 values."""
    return rounded(D.acf(_h(spark, sf), 72))


@register("pacf", f"""
WITH RECURSIVE {panel_sql('H')},
s AS (SELECT unique_id, pos, y - avg(y) OVER (PARTITION BY unique_id) AS e FROM panel WHERE y IS NOT NULL),
c AS (SELECT a.unique_id, k.k AS lag, sum(a.e * b.e) AS s FROM s a CROSS JOIN generate_series(0, 72) AS k(k)
      JOIN s b ON b.unique_id = a.unique_id AND b.pos = a.pos - k.k GROUP BY 1, 2),
r AS (SELECT unique_id, list(s ORDER BY lag) AS r FROM c GROUP BY 1),
z AS (SELECT unique_id, list_transform(r[2:], lambda v: v / r[1]) AS r FROM r),
d AS (SELECT unique_id, r, CAST(1 AS BIGINT) AS k, [r[1]] AS phi, 1 - r[1] * r[1] AS v FROM z
      UNION ALL
      SELECT unique_id, r, k + 1, list_concat(list_transform(generate_series(1, k), lambda j: phi[j] - a * phi[k + 1 - j]), [a]), v * (1 - a * a)
      FROM (SELECT *, (r[k + 1] - list_sum(list_transform(generate_series(1, k), lambda j: phi[j] * r[k + 1 - j]))) / v AS a FROM d WHERE k < 72))
SELECT unique_id, k AS lag, {rnd('phi[k]')} AS pacf FROM d
UNION ALL SELECT unique_id, 0, {rnd('1.0')} FROM z""")
def q_pacf(spark, sf):
    """D-8: Yule-Walker PACF to lag 72 by Durbin-Levinson."""
    return rounded(D.pacf_from_acf(D.acf(_h(spark, sf), 72)))


@register("stationarity_tests")
def q_stationarity(spark, sf):
    """D-9 / D-10 on whole series."""
    return rounded(D.stationarity_tests(_h(spark, sf)))


@register("kpss_level", f"""
WITH {panel_sql('H')},
v AS (SELECT unique_id, row_number() OVER (PARTITION BY unique_id ORDER BY pos) AS t, y FROM panel WHERE y IS NOT NULL),
f AS (SELECT unique_id, count(*) AS n, avg(y) AS m FROM v GROUP BY 1),
e AS (SELECT unique_id, t, n, y - m AS e, sum(y - m) OVER (PARTITION BY unique_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM v JOIN f USING (unique_id)),
z AS (SELECT unique_id, any_value(n) AS n, sum(e * e) AS e0, sum(run * run) AS runs FROM e GROUP BY 1),
short AS (SELECT a.unique_id, k.k, sum(a.e * b.e) AS c FROM e a CROSS JOIN generate_series(1, 40) AS k(k)
          JOIN e b ON b.unique_id = a.unique_id AND b.t = a.t - k.k WHERE k.k <= floor(pow(a.n, 2.0 / 9.0)) GROUP BY 1, 2),
w AS (SELECT z.unique_id, z.n, z.e0, z.runs, least(floor(1.1447 * cbrt(pow((2.0 * sum(k * c) / z.n) / ((z.e0 + 2.0 * sum(c)) / z.n), 2)) * cbrt(z.n)), z.n - 1) AS l
      FROM z JOIN short USING (unique_id) GROUP BY 1, 2, 3, 4),
far AS (SELECT a.unique_id, sum((1.0 - (a.t - b.t) / (w.l + 1.0)) * a.e * b.e) AS c FROM e a JOIN w USING (unique_id)
        JOIN e b ON b.unique_id = a.unique_id AND b.t < a.t AND b.t >= a.t - w.l GROUP BY 1),
k AS (SELECT w.unique_id, w.n, w.l, (w.runs / w.n / w.n) / ((w.e0 + 2.0 * coalesce(far.c, 0)) / w.n) AS s FROM w LEFT JOIN far USING (unique_id))
SELECT unique_id, n AS used_observations, {rnd('s')} AS kpss_statistic, CAST(l AS BIGINT) AS kpss_lags,
       {rnd("CASE WHEN s <= 0.347 THEN 0.10 WHEN s <= 0.463 THEN 0.10 - (s - 0.347) * 0.05 / 0.116 WHEN s <= 0.574 THEN 0.05 - (s - 0.463) * 0.025 / 0.111 WHEN s <= 0.739 THEN 0.025 - (s - 0.574) * 0.015 / 0.165 ELSE 0.01 END")} AS kpss_pvalue
FROM k""")
def q_kpss(spark, sf):
    """D-10: KPSS level statistic, bandwidth and p-value of whole series."""
    return rounded(D.stationarity_tests(_h(spark, sf)).select("unique_id", "used_observations", "kpss_statistic", "kpss_lags", "kpss_pvalue"))


@register("decomposition", f"""
WITH {panel_sql('H')},
lim AS (SELECT unique_id, max(pos) AS n FROM panel GROUP BY 1),
sl AS (SELECT p.* FROM panel p JOIN lim USING (unique_id)),
b AS (SELECT unique_id, min(pos) AS p0, max(pos) AS p1 FROM sl GROUP BY 1),
d AS (SELECT s.*, s.pos - b.p0 AS i, b.p1 - b.p0 AS ni FROM sl s JOIN b USING (unique_id)),
tr AS (SELECT *, CASE WHEN count(y) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
                 THEN (sum(y) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)
                       - 0.5 * (lag(y, 12) OVER (PARTITION BY unique_id ORDER BY pos) + lead(y, 12) OVER (PARTITION BY unique_id ORDER BY pos))) / 24.0
                 END AS t0 FROM d),
fit AS (SELECT unique_id,
          regr_slope(CASE WHEN i < 12 + 24 THEN t0 END, CAST(i AS DOUBLE)) AS k0, regr_intercept(CASE WHEN i < 12 + 24 THEN t0 END, CAST(i AS DOUBLE)) AS b0,
          regr_slope(CASE WHEN i >= ni - 12 - 24 AND i < ni - 12 THEN t0 END, CAST(i AS DOUBLE)) AS k1,
          regr_intercept(CASE WHEN i >= ni - 12 - 24 AND i < ni - 12 THEN t0 END, CAST(i AS DOUBLE)) AS b1
        FROM tr GROUP BY 1),
tt AS (SELECT tr.*, coalesce(t0, CASE WHEN i < 12 THEN k0 * i + b0 ELSE k1 * i + b1 END) AS trend FROM tr JOIN fit USING (unique_id)),
dt AS (SELECT *, y - trend AS det, i % 24 AS ph FROM tt),
pm AS (SELECT unique_id, ph, avg(det) AS m FROM dt GROUP BY 1, 2),
se AS (SELECT unique_id, ph, m - avg(m) OVER (PARTITION BY unique_id) AS seasonal FROM pm)
SELECT dt.unique_id, dt.ds, dt.pos, {rnd('dt.y')} AS y, {rnd('dt.trend')} AS trend, {rnd('se.seasonal')} AS seasonal,
       {rnd('dt.det - se.seasonal')} AS resid
FROM dt JOIN se USING (unique_id, ph)""")
def q_decompose(spark, sf):
    """K-1: classical additive decomposition (period 24, last 2,160 rows)."""
    return rounded(D.decompose(_h(spark, sf), 24))
