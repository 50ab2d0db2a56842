"""Queries: statistical baselines, backtest, scoring, selection, diagnostics."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from tspanel.config import BacktestConfig
from tspanel.operators import baselines as B
from tspanel.operators import diagnose as D
from tspanel.operators import evaluate as E
from tspanel.plans import pipelines as PL
from tspanel.plans.q_pipeline import pipeline_ctes
from tspanel.plans.registry import R, register, rnd
from tspanel.plans.util import rounded
from tspanel.sources.panels import panel, panel_sql, prepared_panel

#: The training history is not capped.
CAP = 10 ** 15


def baseline_sql(cuts_sql: str, h: int = 24, m: int = 24, big: int = 168, cap: int = CAP) -> str:
    """CTEs computing the six baselines with bands for the cutoffs in
    ``cuts(unique_id, win, cut)``; result CTE ``fc`` (validated)."""
    CAP = cap  # noqa: N806
    lo = f"greatest(1, c.cut - {CAP - 1})"
    return f"""
cuts AS ({cuts_sql}),
steps AS (SELECT c.unique_id, c.win, c.cut, h.h FROM cuts c, generate_series(1, {h}) AS h(h)),
lastv AS (SELECT c.unique_id, c.win, c.cut, p.y AS last_y FROM cuts c
          LEFT JOIN panel p ON p.unique_id = c.unique_id AND p.pos = c.cut),
f_naive AS (SELECT s.unique_id, s.win, s.cut, s.h, 'naive' AS model, l.last_y AS y_pred
            FROM steps s JOIN lastv l USING (unique_id, win, cut)),
f_sn AS (SELECT s.unique_id, s.win, s.cut, s.h, 'seasonal_naive_' || CAST(m.m AS VARCHAR) AS model, p.y AS y_pred
         FROM steps s CROSS JOIN (VALUES ({m}), ({big})) AS m(m)
         LEFT JOIN panel p ON p.unique_id = s.unique_id AND p.pos = CASE
              WHEN s.cut - greatest(1, s.cut - {CAP - 1}) + 1 < m.m THEN s.cut
              ELSE s.cut - (m.m - 1) + (s.h - 1) % m.m END),
wa AS (SELECT c.unique_id, c.win, c.cut, avg(p.y) AS v FROM cuts c
       JOIN panel p ON p.unique_id = c.unique_id AND p.pos BETWEEN greatest({lo}, c.cut - {big - 1}) AND c.cut GROUP BY 1, 2, 3),
f_wa AS (SELECT s.unique_id, s.win, s.cut, s.h, 'window_average_{big}' AS model, wa.v AS y_pred
         FROM steps s JOIN wa USING (unique_id, win, cut)),
swa_src AS (SELECT s.unique_id, s.win, s.cut, s.h, s.cut - {m - 1} + (s.h - 1) % {m} - k.k * {m} AS sp
            FROM steps s, generate_series(0, 6) AS k(k)),
swa AS (SELECT s.unique_id, s.win, s.cut, s.h, avg(p.y) AS v FROM swa_src s
        JOIN panel p ON p.unique_id = s.unique_id AND p.pos = s.sp
        WHERE s.sp >= greatest(1, s.cut - {CAP - 1}) AND s.sp <= s.cut GROUP BY 1, 2, 3, 4),
f_swa AS (SELECT s.unique_id, s.win, s.cut, s.h, 'seasonal_window_average' AS model, coalesce(swa.v, l.last_y) AS y_pred
          FROM steps s LEFT JOIN swa USING (unique_id, win, cut, h) JOIN lastv l USING (unique_id, win, cut)),
dr AS (SELECT c.unique_id, c.win, c.cut, {lo} AS fp, pf.y AS first_y, pl.y AS last_y FROM cuts c
       LEFT JOIN panel pf ON pf.unique_id = c.unique_id AND pf.pos = {lo}
       LEFT JOIN panel pl ON pl.unique_id = c.unique_id AND pl.pos = c.cut),
f_dr AS (SELECT s.unique_id, s.win, s.cut, s.h, 'drift' AS model,
                d.last_y + (CASE WHEN d.cut - d.fp + 1 > 1 THEN (d.last_y - d.first_y) / (d.cut - d.fp) ELSE 0.0 END) * s.h AS y_pred
         FROM steps s JOIN dr d USING (unique_id, win, cut)),
dd AS (SELECT a.unique_id, a.pos, a.y - b.y AS dm, a.y - c.y AS d1 FROM panel a
       LEFT JOIN panel b ON b.unique_id = a.unique_id AND b.pos = a.pos - {m}
       LEFT JOIN panel c ON c.unique_id = a.unique_id AND c.pos = a.pos - 1),
sc24 AS (SELECT c.unique_id, c.win, c.cut, stddev_pop(dd.dm) AS s FROM cuts c
         JOIN dd ON dd.unique_id = c.unique_id AND dd.pos BETWEEN {lo} + {m} AND c.cut GROUP BY 1, 2, 3),
sc1 AS (SELECT c.unique_id, c.win, c.cut, stddev_pop(dd.d1) AS s FROM cuts c
        JOIN dd ON dd.unique_id = c.unique_id AND dd.pos BETWEEN {lo} + 1 AND c.cut GROUP BY 1, 2, 3),
scl0 AS (SELECT c.unique_id, c.win, c.cut,
                CASE WHEN c.cut - {lo} + 1 > {m} THEN a.s WHEN c.cut - {lo} + 1 > 1 THEN b.s ELSE 0.1 END AS s
         FROM cuts c LEFT JOIN sc24 a USING (unique_id, win, cut) LEFT JOIN sc1 b USING (unique_id, win, cut)),
scl AS (SELECT unique_id, win, cut,
               CASE WHEN s IS NOT NULL AND NOT isnan(s) AND s > 0 AND NOT isinf(s) THEN s ELSE 0.1 END AS scale FROM scl0),
allf AS (SELECT * FROM f_naive UNION ALL SELECT * FROM f_sn UNION ALL SELECT * FROM f_wa
         UNION ALL SELECT * FROM f_swa UNION ALL SELECT * FROM f_dr),
okf AS (SELECT unique_id, win, cut, model FROM allf GROUP BY 1, 2, 3, 4
        HAVING count(*) = {h} AND count(*) FILTER (WHERE y_pred IS NULL OR isnan(y_pred) OR isinf(y_pred)) = 0),
fc AS (SELECT a.*, a.y_pred - 1.28 * s.scale AS lower_80, a.y_pred + 1.28 * s.scale AS upper_80,
              a.y_pred - 1.96 * s.scale AS lower_95, a.y_pred + 1.96 * s.scale AS upper_95
       FROM allf a SEMI JOIN okf USING (unique_id, win, cut, model) LEFT JOIN scl s USING (unique_id, win, cut))"""


def backtest_cuts_sql(h: int = 24, windows: int = 3, step: int = 24, min_hist: int = 336) -> str:
    return (f"SELECT l.unique_id, g.win, l.n - {h} - {windows - 1} * {step} + (g.win - 1) * {step} AS cut "
            f"FROM (SELECT unique_id, max(pos) AS n FROM panel GROUP BY 1) l, generate_series(1, {windows}) AS g(win) "
            f"WHERE l.n >= {h} + {windows - 1} * {step} + {max(min_hist, h)}")


BACKTEST_CUTS = backtest_cuts_sql()
FINAL_CUTS = "SELECT unique_id, 0 AS win, max(pos) AS cut FROM panel GROUP BY 1"

SCORING_SQL_T = """
preds AS (SELECT f.*, p.ds, p.y, p.y - f.y_pred AS residual, pc.ds AS cutoff FROM fc f
          LEFT JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut + f.h
          LEFT JOIN panel pc ON pc.unique_id = f.unique_id AND pc.pos = f.cut),
ins24 AS (SELECT c.unique_id, c.win, avg(abs(dd.dm)) AS m FROM cuts c
          JOIN dd ON dd.unique_id = c.unique_id AND dd.pos BETWEEN 1 + {m} AND c.cut GROUP BY 1, 2),
ins1 AS (SELECT c.unique_id, c.win, avg(abs(dd.d1)) AS m FROM cuts c
         JOIN dd ON dd.unique_id = c.unique_id AND dd.pos BETWEEN 2 AND c.cut GROUP BY 1, 2),
ins AS (SELECT c.unique_id, c.win, greatest(CASE WHEN c.cut > {m} THEN a.m ELSE b.m END, 1e-8) AS mase_scale
        FROM cuts c LEFT JOIN ins24 a USING (unique_id, win) LEFT JOIN ins1 b USING (unique_id, win)),
bw AS (SELECT unique_id, model, win, avg(abs(y - y_pred)) AS mae, sqrt(avg((y - y_pred) * (y - y_pred))) AS rmse,
              avg(abs((y - y_pred) / greatest(abs(y), 1e-8))) * 100 AS mape,
              avg(abs(y - y_pred) / greatest((abs(y) + abs(y_pred)) / 2.0, 1e-8)) * 100 AS smape
       FROM preds GROUP BY 1, 2, 3),
bw2 AS (SELECT bw.*, bw.mae / ins.mase_scale AS mase FROM bw LEFT JOIN ins USING (unique_id, win)),
lb0 AS (SELECT unique_id, model, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape, avg(smape) AS smape,
               avg(mase) AS mase FROM bw2 GROUP BY 1, 2),
lb AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY smape ASC NULLS LAST, model) AS rank FROM lb0)"""


def scoring_sql(m: int = 24) -> str:
    return SCORING_SQL_T.replace("{m}", str(m))


SCORING_SQL = scoring_sql(24)


def _stat_backtest(spark, sf):
    return PL.statistical_backtest(prepared_panel(spark, sf, "H"), BacktestConfig())


# ---------------------------------------------------------------- F-10

@register("backtest_cutoffs", f"""
WITH {panel_sql('H')}, cuts AS ({BACKTEST_CUTS})
SELECT c.unique_id, c.win AS "window", c.cut, p.ds AS cutoff FROM cuts c
JOIN panel p ON p.unique_id = c.unique_id AND p.pos = c.cut""")
def q_cutoffs(spark, sf):
    p = prepared_panel(spark, sf, "H")
    c = B.backtest_cutoffs(p, 24, 3, 24)
    return rounded(PL.with_cutoff_ds(c, p).select("unique_id", "window", "cut", "cutoff"))


# ---------------------------------------------------------------- F-1..F-9, P-12, J-1, J-5, J-6

@register("statistical_backtest_predictions", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}
SELECT unique_id, win AS "window", cutoff, ds, CAST(h AS BIGINT) AS horizon, model,
       {R('y y_pred lower_80 upper_80 lower_95 upper_95 residual')} FROM preds""")
def q_stat_preds(spark, sf):
    preds, _, _ = _stat_backtest(spark, sf)
    return rounded(preds.select("unique_id", "window", "cutoff", "ds", "horizon", "model", "y", "y_pred",
                                "lower_80", "upper_80", "lower_95", "upper_95", "residual"))


# ---------------------------------------------------------------- E-1..E-4, E-7

@register("statistical_metrics_by_window", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}
SELECT unique_id, model, win AS "window", {R('mae rmse mape smape mase')} FROM bw2""")
def q_stat_bw(spark, sf):
    _, bw, _ = _stat_backtest(spark, sf)
    return rounded(bw.select("unique_id", "model", "window", "mae", "rmse", "mape", "smape", "mase"))


@register("statistical_leaderboard", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}
SELECT unique_id, CAST(rank AS BIGINT) AS rank, model, {R('mae rmse mape smape mase')} FROM lb""")
def q_stat_lb(spark, sf):
    _, _, lb = _stat_backtest(spark, sf)
    return rounded(lb)


# ---------------------------------------------------------------- E-8, P-9, P-10, T-3

def _values_sql(mapping: dict[str, str], k: str, v: str) -> str:
    rows = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in mapping.items())
    return f"(VALUES {rows}) AS t({k}, {v})"


@register("statistical_selection", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL},
grp AS (SELECT * FROM {_values_sql(E.STATISTICAL_GROUPS, 'model', 'grp')}),
notes AS (SELECT * FROM {_values_sql(E.MODEL_NOTES, 'model', 'comment')})
SELECT lb.unique_id, CAST(lb.rank AS BIGINT) AS rank, coalesce(grp.grp, 'statistical') AS "group", lb.model,
       {R('mae rmse mape smape mase')}, coalesce(notes.comment, '') AS comment,
       CASE WHEN lb.rank = 1 THEN 'primary candidate' ELSE 'comparison model' END AS decision
FROM lb LEFT JOIN grp USING (model) LEFT JOIN notes USING (model)""")
def q_stat_selection(spark, sf):
    _, _, lb = _stat_backtest(spark, sf)
    return rounded(E.selection_table(lb))


@register("best_model", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}
SELECT unique_id, model FROM lb WHERE rank = 1""")
def q_best(spark, sf):
    _, _, lb = _stat_backtest(spark, sf)
    return E.best_model(lb)


@register("top_k_models", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}
SELECT unique_id, CAST(rank AS BIGINT) AS rank, model, {R('mae rmse mape smape mase')} FROM lb WHERE rank <= 3""")
def q_topk(spark, sf):
    """T-2: the three best models per series."""
    _, _, lb = _stat_backtest(spark, sf)
    return rounded(E.top_k(lb, 3))


# ---------------------------------------------------------------- D-1..D-4

@register("residual_diagnostics", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL},
best AS (SELECT unique_id, model FROM lb WHERE rank = 1),
r0 AS (SELECT p.*, row_number() OVER (PARTITION BY p.unique_id, p.model ORDER BY p.win, p.h) AS seq
       FROM preds p SEMI JOIN best USING (unique_id, model)),
r1 AS (SELECT *, residual - avg(residual) OVER (PARTITION BY unique_id, model) AS e,
              lag(residual) OVER (PARTITION BY unique_id, model ORDER BY seq) AS prev FROM r0),
r2 AS (SELECT *, {', '.join(f'e * lag(e, {k}) OVER (PARTITION BY unique_id, model ORDER BY seq) AS p{k}' for k in range(1, 25))} FROM r1),
lbq AS (SELECT unique_id, model, count(e) AS n, sum(e * e) AS c0, {', '.join(f'sum(p{k}) AS c{k}' for k in range(1, 25))}
        FROM r2 GROUP BY 1, 2),
lbs AS (SELECT unique_id, model, n,
               n * (n + 2.0) * ({' + '.join(f'(c{k} / c0) * (c{k} / c0) / (n - {k})' for k in range(1, 25))}) AS q FROM lbq),
lbp AS (SELECT unique_id, model, CASE WHEN n > 24 THEN exp(-(q / 2.0)) * ({' + '.join(f'pow(q / 2.0, {float(j)}) / {float(math.factorial(j))}' for j in range(12))}) END AS p FROM lbs),
agg AS (SELECT unique_id, model, avg(residual) AS residual_mean, stddev_pop(residual) AS residual_std,
               avg(abs(residual)) AS residual_mae, quantile_cont(residual, 0.5) AS residual_median,
               corr(residual, prev) AS residual_lag1_autocorr,
               CASE WHEN count(lower_80) > 0 AND count(upper_80) > 0 THEN avg(CASE WHEN y >= lower_80 AND y <= upper_80 THEN 1.0 ELSE 0.0 END) END AS coverage_80,
               CASE WHEN count(lower_95) > 0 AND count(upper_95) > 0 THEN avg(CASE WHEN y >= lower_95 AND y <= upper_95 THEN 1.0 ELSE 0.0 END) END AS coverage_95
        FROM r1 GROUP BY 1, 2)
SELECT a.unique_id, a.model, {R('residual_mean residual_std residual_mae residual_median residual_lag1_autocorr coverage_80 coverage_95')},
       {rnd('lbp.p')} AS ljung_box_pvalue
FROM agg a LEFT JOIN lbp USING (unique_id, model)""")
def q_resid_diag(spark, sf):
    preds, _, lb = _stat_backtest(spark, sf)
    return rounded(D.residual_diagnostics(preds, E.best_model(lb)))


# ---------------------------------------------------------------- F-12, X-9

@register("statistical_final_forecast", f"""
WITH {panel_sql('H')}, {baseline_sql(FINAL_CUTS)}
SELECT f.unique_id, p.ds + to_hours(CAST(f.h AS BIGINT)) AS ds, CAST(f.h AS BIGINT) AS horizon, f.model,
       {R('y_pred lower_80 upper_80 lower_95 upper_95')}
FROM fc f JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut""")
def q_final_forecast(spark, sf):
    fc = PL.statistical_forecast(prepared_panel(spark, sf, "H"))
    return rounded(fc.select("unique_id", "ds", "horizon", "model", "y_pred", "lower_80", "upper_80", "lower_95", "upper_95"))


@register("pipeline_forecast", f"""
WITH {panel_sql('H')}, cuts AS ({FINAL_CUTS}),
steps AS (SELECT c.unique_id, c.win, c.cut, h.h FROM cuts c, generate_series(1, 24) AS h(h)),
how AS (SELECT s.unique_id, s.h, avg(p.y) AS v FROM steps s, generate_series(1, 8) AS k(k)
        JOIN panel p ON p.unique_id = s.unique_id AND p.pos = s.cut + s.h - k.k * 168
        WHERE s.cut + s.h - k.k * 168 >= 1 GROUP BY 1, 2),
fb AS (SELECT c.unique_id, avg(p.y) AS v FROM cuts c JOIN panel p ON p.unique_id = c.unique_id
       AND p.pos BETWEEN greatest(1, c.cut - 23) AND c.cut GROUP BY 1),
lastp AS (SELECT c.unique_id, p.y AS v, p.ds FROM cuts c JOIN panel p ON p.unique_id = c.unique_id AND p.pos = c.cut)
SELECT s.unique_id, l.ds + to_hours(CAST(s.h AS BIGINT)) AS ds, CAST(s.h AS BIGINT) AS horizon,
       'seasonal_how_average' AS model, {rnd('coalesce(how.v, fb.v, l.v)')} AS y_pred
FROM steps s LEFT JOIN how USING (unique_id, h) LEFT JOIN fb USING (unique_id) JOIN lastp l USING (unique_id)""")
def q_pipeline_forecast(spark, sf):
    """F-12 of the final pipeline (hour-of-week average past the end)."""
    return rounded(PL.pipeline_forecast(prepared_panel(spark, sf, "H")))


# ---------------------------------------------------------------- M-1, M-2

@register("melt_forecasts", f"""
WITH {panel_sql('H')}, {baseline_sql(FINAL_CUTS)}
SELECT f.unique_id, p.ds + to_hours(CAST(f.h AS BIGINT)) AS ds, f.model, {rnd('f.y_pred')} AS y_pred
FROM fc f JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut""")
def q_melt(spark, sf):
    """M-1: forecasts pivoted wide (one column per model) and melted back."""
    fc = PL.statistical_forecast(prepared_panel(spark, sf, "H"))
    models = list(B.BASELINE_MODELS)
    wide = fc.groupBy("unique_id", "ds").pivot("model", models).agg(F.first("y_pred"))
    return rounded(E.melt_forecasts(wide, ["unique_id", "ds"]).select("unique_id", "ds", "model", "y_pred"))


@register("interval_columns_to_long", f"""
WITH {panel_sql('H')}, {baseline_sql(FINAL_CUTS)}
SELECT f.unique_id, p.ds + to_hours(CAST(f.h AS BIGINT)) AS ds, f.model,
       {R('y_pred lower_80 upper_80 lower_95 upper_95')}
FROM fc f JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut""")
def q_intervals(spark, sf):
    """M-2: ``<model>``, ``<model>-lo-80`` … columns split back into long rows."""
    fc = PL.statistical_forecast(prepared_panel(spark, sf, "H"))
    parts = []
    for kind, suffix in (("y_pred", ""), ("lower_80", "-lo-80"), ("upper_80", "-hi-80"),
                         ("lower_95", "-lo-95"), ("upper_95", "-hi-95")):
        parts.append(fc.select("unique_id", "ds", F.concat(F.col("model"), F.lit(suffix)).alias("_c"), F.col(kind).alias("_v")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    cols = [m + s for m in B.BASELINE_MODELS for s in ("", "-lo-80", "-hi-80", "-lo-95", "-hi-95")]
    wide = long.groupBy("unique_id", "ds").pivot("_c", cols).agg(F.first("_v"))
    out = E.split_interval_columns(wide, ["unique_id", "ds"])
    return rounded(out.select("unique_id", "ds", "model", "y_pred", "lower_80", "upper_80", "lower_95", "upper_95"))


# ---------------------------------------------------------------- A-13, W-8, F-22

@register("cv_labelling", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}
SELECT unique_id, model, ds, cutoff,
       CAST(dense_rank() OVER (PARTITION BY unique_id ORDER BY cutoff) AS BIGINT) AS "window",
       CAST(row_number() OVER (PARTITION BY unique_id, model, cutoff ORDER BY ds) AS BIGINT) AS horizon
FROM preds""")
def q_cv_labels(spark, sf):
    """Window numbers from distinct cutoffs and horizon numbers by running
    count, recomputed from the prediction rows alone."""
    preds, _, _ = _stat_backtest(spark, sf)
    p = preds.select("unique_id", "model", "ds", "cutoff")
    wins = p.select("unique_id", "cutoff").distinct().withColumn(
        "window", F.dense_rank().over(Window.partitionBy("unique_id").orderBy("cutoff")))
    out = p.join(wins, ["unique_id", "cutoff"])
    out = out.withColumn("horizon", F.row_number().over(Window.partitionBy("unique_id", "model", "cutoff").orderBy("ds")))
    return rounded(out.select("unique_id", "model", "ds", "cutoff", "window", "horizon"))


# ---------------------------------------------------------------- E-9, U-1

@register("combined_leaderboard", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}, {pipeline_ctes('p_')},
u AS (SELECT unique_id, 'statistical' AS "group", model, mae, rmse, mape, smape, mase FROM lb0
      UNION ALL SELECT unique_id, 'pipeline', model, mae, rmse, mape, smape, mase FROM p_lb)
SELECT unique_id, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY smape ASC NULLS LAST, model) AS BIGINT) AS rank,
       "group", model, {R('mae rmse mape smape mase')}
FROM u WHERE smape IS NOT NULL""")
def q_combined_lb(spark, sf):
    """E-9: statistical and pipeline leaderboards re-ranked together."""
    p = prepared_panel(spark, sf, "H")
    _, _, lb = PL.statistical_backtest(p)
    _, _, plb = PL.pipeline_backtest(p)
    out = E.combine_leaderboards(lb.withColumn("group", F.lit("statistical")), plb.withColumn("group", F.lit("pipeline")))
    return rounded(out)


@register("merged_selection", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS)}, {SCORING_SQL}, {pipeline_ctes('p_')},
notes AS (SELECT * FROM {_values_sql(E.MODEL_NOTES, 'model', 'comment')}),
u AS (SELECT unique_id, 'statistical' AS "group", model, mae, rmse, smape, mase FROM lb0
      UNION ALL SELECT unique_id, 'pipeline', model, mae, rmse, smape, mase FROM p_lb),
r AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY smape ASC NULLS LAST, model) AS rank FROM u WHERE smape IS NOT NULL)
SELECT unique_id, CAST(rank AS BIGINT) AS rank, "group", model, {R('mae rmse smape mase')}, coalesce(comment, '') AS comment,
       CASE WHEN rank = 1 THEN 'primary data-driven candidate' ELSE 'comparison model' END AS decision
FROM r LEFT JOIN notes USING (model)""")
def q_merged_selection(spark, sf):
    """J-4 / E-8: selection tables of two groups joined to their combined, re-ranked leaderboard."""
    p = prepared_panel(spark, sf, "H")
    _, _, lb = PL.statistical_backtest(p)
    _, _, plb = PL.pipeline_backtest(p)
    board = E.combine_leaderboards(lb.withColumn("group", F.lit("statistical")), plb.withColumn("group", F.lit("pipeline")))
    return rounded(E.combine_selection_tables([E.selection_table(lb, "statistical"), E.selection_table(plb, "pipeline")], board))


# ---------------------------------------------------------------- X-8, F-9, F-11 where they bind

_LONG, _LAST, _MANY = 60, 100, 40


@register("forecast_beyond_season", f"""
WITH {panel_sql('H')}, {baseline_sql(FINAL_CUTS, h=_LONG)}
SELECT f.unique_id, p.ds + to_hours(CAST(f.h AS BIGINT)) AS ds, CAST(f.h AS BIGINT) AS horizon, f.model,
       {R('y_pred lower_80 upper_80 lower_95 upper_95')}
FROM fc f JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut""")
def q_beyond_season(spark, sf):
    """X-8: the last season is tiled over a horizon of two and a half seasons."""
    fc = PL.statistical_forecast(prepared_panel(spark, sf, "H"), BacktestConfig(horizon=_LONG))
    return rounded(fc.select("unique_id", "ds", "horizon", "model", "y_pred", "lower_80", "upper_80", "lower_95", "upper_95"))


@register("recent_history_backtest", f"""
WITH {panel_sql('H')}, {baseline_sql(BACKTEST_CUTS, cap=_LAST)}
SELECT f.unique_id, CAST(f.win AS BIGINT) AS "window", CAST(f.h AS BIGINT) AS horizon, f.model,
       {R('y_pred lower_80 upper_80 lower_95 upper_95')} FROM fc f""")
def q_recent_history(spark, sf):
    """F-9: a caller's wish to train on the last rows only, fewer than the long season."""
    preds, _, _ = PL.statistical_backtest(prepared_panel(spark, sf, "H"), BacktestConfig(max_history=_LAST))
    return rounded(preds.select("unique_id", "window", "horizon", "model", "y_pred", "lower_80", "upper_80", "lower_95", "upper_95"))


@register("shrunken_windows", f"""
WITH {panel_sql('H')}, l AS (SELECT unique_id, max(pos) AS n FROM panel GROUP BY 1),
w AS (SELECT unique_id, n, CASE WHEN n < {168 + 24 * (_MANY + 1)} THEN greatest(1, least({_MANY}, (n - 168) // 24 - 1)) ELSE {_MANY} END AS w FROM l)
SELECT unique_id, CAST(g.g AS BIGINT) AS "window", CAST(n - (w - g.g + 1) * 24 AS BIGINT) AS cut, CAST(n AS BIGINT) AS n
FROM w, generate_series(1, {_MANY}) g(g) WHERE g.g <= w AND n - (w - g.g + 1) * 24 >= 1""")
def q_shrunken(spark, sf):
    """F-11: more windows are wanted than the series has room for."""
    return rounded(B.pipeline_cutoffs(prepared_panel(spark, sf, "H"), n_windows=_MANY))


# ---------------------------------------------------------------- E-10

@register("baseline_comparison", f"""
WITH {panel_sql('H')},
cuts AS (SELECT unique_id, 1 AS win, max(pos) - least(168, greatest(24, max(pos) // 5)) AS cut FROM panel GROUP BY 1),
steps AS (SELECT c.unique_id, c.win, c.cut, h.h FROM cuts c, generate_series(1, 24) AS h(h)),
lastv AS (SELECT c.unique_id, c.win, c.cut, p.y AS last_y FROM cuts c LEFT JOIN panel p ON p.unique_id = c.unique_id AND p.pos = c.cut),
f AS (SELECT s.unique_id, s.win, s.cut, s.h, 'naive' AS model, l.last_y AS y_pred FROM steps s JOIN lastv l USING (unique_id, win, cut)
      UNION ALL
      SELECT s.unique_id, s.win, s.cut, s.h, 'seasonal_naive_24', p.y FROM steps s LEFT JOIN panel p ON p.unique_id = s.unique_id
        AND p.pos = CASE WHEN s.cut < 24 THEN s.cut ELSE s.cut - 23 + (s.h - 1) % 24 END),
pr AS (SELECT f.*, p.y FROM f LEFT JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut + f.h),
dd AS (SELECT a.unique_id, a.pos, abs(a.y - b.y) AS d24 FROM panel a JOIN panel b ON b.unique_id = a.unique_id AND b.pos = a.pos - 24),
ins AS (SELECT c.unique_id, greatest(avg(dd.d24), 1e-8) AS s FROM cuts c JOIN dd ON dd.unique_id = c.unique_id AND dd.pos <= c.cut GROUP BY 1)
SELECT pr.unique_id, pr.model, {rnd('avg(abs(y - y_pred))')} AS mae, {rnd('sqrt(avg((y - y_pred) * (y - y_pred)))')} AS rmse,
       {rnd('avg(abs((y - y_pred) / greatest(abs(y), 1e-8))) * 100')} AS mape,
       {rnd('avg(abs(y - y_pred) / greatest((abs(y) + abs(y_pred)) / 2.0, 1e-8)) * 100')} AS smape,
       {rnd('avg(abs(y - y_pred)) / any_value(ins.s)')} AS mase
FROM pr JOIN ins USING (unique_id) GROUP BY 1, 2""")
def q_baseline_comparison(spark, sf):
    """E-10: naive vs seasonal naive on a held-out tail of
    ``min(168, max(24, n // 5))`` rows, first 24 test rows scored."""
    p = prepared_panel(spark, sf, "H")
    from tspanel.operators.prepare import series_length
    n = F.col("n")
    cuts = series_length(p).select("unique_id", F.lit(1).alias("window"),
                                   (n - F.least(F.lit(168), F.greatest(F.lit(24), F.floor(n / 5)))).cast("long").alias("cut"), "n")
    fc = B.naive(p, cuts, 24).unionByName(B.seasonal_naive(p, cuts, 24, 24, max_history=10 ** 15))
    preds = B.attach_actuals(fc, p)
    bw = E.metrics_by_window(preds, E.insample_scale(p, cuts, 24), "clamped")
    return rounded(bw.select("unique_id", "model", "mae", "rmse", "mape", "smape", "mase"))


# ---------------------------------------------------------------- D-4..D-6 statistics (p-values: R check)

PIPE_TESTS_SQL = """
fin0 AS (SELECT unique_id, win, h, residual FROM p_preds WHERE model = 'seasonal_how_average' AND residual IS NOT NULL),
bas0 AS (SELECT unique_id, win, h, residual FROM p_preds WHERE model = 'seasonal_naive_168' AND residual IS NOT NULL),
fin AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY win, h) AS seq,
               residual - avg(residual) OVER (PARTITION BY unique_id) AS e FROM fin0),
bias AS (SELECT unique_id, count(*) AS n, avg(residual) / (stddev_samp(residual) / sqrt(count(*))) AS stat FROM fin GROUP BY 1),
lbp AS (SELECT *, {prods} FROM fin),
lbq AS (SELECT unique_id, count(e) AS n, sum(e * e) AS c0, {sums} FROM lbp GROUP BY 1),
lbs AS (SELECT unique_id, n, CAST(least(24, greatest(1, floor(n / 3))) AS INTEGER) AS lag, {qcase} AS stat FROM lbq),
pair AS (SELECT f.unique_id, abs(f.residual) - abs(b.residual) AS d FROM fin0 f JOIN bas0 b USING (unique_id, win, h)),
cnt AS (SELECT unique_id, (SELECT count(*) FROM fin0 x WHERE x.unique_id = f.unique_id) AS nf,
               (SELECT count(*) FROM bas0 x WHERE x.unique_id = f.unique_id) AS nb FROM (SELECT DISTINCT unique_id FROM fin0) f),
pt AS (SELECT p.unique_id, count(d) AS n, avg(d) / (stddev_samp(d) / sqrt(count(d))) AS stat FROM pair p
       JOIN cnt c USING (unique_id) WHERE c.nf = c.nb GROUP BY 1)"""


def _pipe_tests_sql() -> str:
    prods = ", ".join(f"e * lag(e, {k}) OVER (PARTITION BY unique_id ORDER BY seq) AS p{k}" for k in range(1, 25))
    sums = ", ".join(f"sum(p{k}) AS c{k}" for k in range(1, 25))
    cases = []
    for lag in range(1, 25):
        q = " + ".join(f"(c{k} / c0) * (c{k} / c0) / (n - {k})" for k in range(1, lag + 1))
        cases.append(f"WHEN least(24, greatest(1, floor(n / 3))) = {lag} THEN n * (n + 2.0) * ({q})")
    return PIPE_TESTS_SQL.format(prods=prods, sums=sums, qcase="CASE " + " ".join(cases) + " END")




@register("pipeline_test_statistics", f"""
WITH {panel_sql('H')}, {pipeline_ctes('p_')}, {_pipe_tests_sql()}
SELECT unique_id, 'bias_ttest' AS test, {rnd('stat')} AS statistic FROM bias WHERE n >= 10
UNION ALL SELECT unique_id, 'ljung_box_lag_' || CAST(lag AS VARCHAR), {rnd('stat')} FROM lbs WHERE n >= 30
UNION ALL SELECT unique_id, 'paired_ttest_vs_seasonal_naive_168', {rnd('stat')} FROM pt WHERE n >= 10""")
def q_pipe_test_stats(spark, sf):
    """D-4..D-6 statistics of the final pipeline (p-values in the R query)."""
    preds, _, _ = PL.pipeline_backtest(prepared_panel(spark, sf, "H"))
    t = D.pipeline_tests(preds, with_pvalues=False)
    return rounded(t.select("unique_id", "test", "statistic"))


def _t_sql(stat: str, n: str) -> str:
    """Two-sided p-value of ``stat`` with n - 1 degrees of freedom: sums of gamma quotients times powers of the cosine."""
    th, nu = f"atan(abs({stat}) / sqrt({n} - 1))", f"({n} - 1)"
    even = f"list_sum([exp(lgamma(k + 0.5) - lgamma(k + 1)) * pow(cos({th}), 2 * k) FOR k IN range(0, {nu} // 2)]) / sqrt(pi())"
    odd = f"coalesce(list_sum([exp(lgamma(k + 1) - lgamma(k + 1.5)) * pow(cos({th}), 2 * k + 1) FOR k IN range(0, ({nu} - 1) // 2)]), 0) * sqrt(pi()) / 2"
    return f"CASE WHEN {nu} % 2 = 0 THEN 1 - sin({th}) * {even} ELSE 1 - ({th} + sin({th}) * {odd}) * 2 / pi() END"


def _chi2_sql(stat: str, df: str) -> str:
    """Upper tail: one minus the series of the incomplete gamma function."""
    return f"1 - list_sum([exp((k + {df} / 2.0) * ln({stat} / 2) - {stat} / 2 - lgamma(k + {df} / 2.0 + 1)) FOR k IN range(0, 2000)])"


@register("pipeline_statistical_tests", f"""
WITH {panel_sql('H')}, {pipeline_ctes('p_')}, {_pipe_tests_sql()},
tests AS (
    SELECT unique_id, 'bias_ttest' AS test, stat, {_t_sql('stat', 'n')} AS p, NULL AS better FROM bias WHERE n >= 10
    UNION ALL SELECT unique_id, 'ljung_box_lag_' || CAST(lag AS VARCHAR), stat, {_chi2_sql('stat', 'lag')}, NULL FROM lbs WHERE n >= 30
    UNION ALL SELECT unique_id, 'paired_ttest_vs_seasonal_naive_168', stat, {_t_sql('stat', 'n')}, stat <= 0 FROM pt WHERE n >= 10)
SELECT unique_id, test, {rnd('stat')} AS statistic, {rnd('p')} AS pvalue, CASE WHEN coalesce(better, p >= 0.05) THEN 'pass' ELSE 'warn' END AS status FROM tests""")
def q_pipe_tests(spark, sf):
    """D-4..D-6 with p-values and pass/warn status."""
    preds, _, _ = PL.pipeline_backtest(prepared_panel(spark, sf, "H"))
    return rounded(D.pipeline_tests(preds))


# ---------------------------------------------------------------- the same operators on a daily panel
# Daily lineitem panel (mean quantity per return flag, values ~25): 6-decimal
# comparison of band values is meaningful at this magnitude; on the orders
# panel (values ~1e5) it would need ~1e-11 relative agreement between two
# different standard-deviation algorithms.

DAILY_MODELS = ("naive", "seasonal_naive_7", "seasonal_naive_28", "window_average_28", "seasonal_window_average", "drift")
DAILY_CFG = BacktestConfig(horizon=7, n_windows=3, step=7, season=7, min_history=7 * 14)


def _daily_backtest(spark, sf):
    return PL.statistical_backtest(prepared_panel(spark, sf, "L"), DAILY_CFG, models=DAILY_MODELS, long_season=28)


@register("statistical_backtest_daily_predictions", f"""
WITH {panel_sql('L')}, {baseline_sql(backtest_cuts_sql(7, 3, 7, 98), h=7, m=7, big=28)}, {scoring_sql(7)}
SELECT unique_id, win AS "window", cutoff, ds, CAST(h AS BIGINT) AS horizon, model,
       {R('y y_pred lower_80 upper_80 lower_95 upper_95 residual')} FROM preds""")
def q_daily_preds(spark, sf):
    """F-1..F-10 on the daily lineitem panel: horizon 7, seasons 7 and 28."""
    preds, _, _ = _daily_backtest(spark, sf)
    return rounded(preds.select("unique_id", "window", "cutoff", "ds", "horizon", "model", "y", "y_pred",
                                "lower_80", "upper_80", "lower_95", "upper_95", "residual"))


@register("statistical_leaderboard_daily", f"""
WITH {panel_sql('L')}, {baseline_sql(backtest_cuts_sql(7, 3, 7, 98), h=7, m=7, big=28)}, {scoring_sql(7)}
SELECT unique_id, CAST(rank AS BIGINT) AS rank, model, {R('mae rmse mape smape mase')} FROM lb""")
def q_daily_lb(spark, sf):
    _, _, lb = _daily_backtest(spark, sf)
    return rounded(lb)
