"""Queries: regular grid and the final-pipeline backtest (flagship)."""

from __future__ import annotations

import re

from tspanel.plans import pipelines as PL
from tspanel.plans.registry import R, register, rnd
from tspanel.plans.util import rounded
from tspanel.sources.panels import panel, panel_sql, prepared_panel


# ============================================================ R-1, R-3, R-5 (+ W-0)

@register("regular_grid_time_fill", f"""
WITH {panel_sql('H', 'time')}
SELECT unique_id, ds, {rnd('y')} AS y, pos FROM panel""")
def q_regular_grid(spark, sf):
    return rounded(panel(spark, sf, "H", fill="time"))


# ============================================================ F-11 / F-5 / F-2 / E-5 / E-6 / W-9 (flagship)

PIPELINE_CTES = """
lens AS (SELECT unique_id, max(pos) AS n FROM panel GROUP BY 1),
wc AS (SELECT unique_id, n,
         CAST(CASE WHEN n < 168 + 24 * 6 THEN greatest(1, least(5, floor((n - 168) / 24) - 1)) ELSE 5 END AS BIGINT) AS w
       FROM lens),
cuts AS (SELECT wc.unique_id, g.win, wc.n - (wc.w - g.win + 1) * 24 AS cut
         FROM wc, generate_series(1, wc.w) AS g(win)),
cuts1 AS (SELECT * FROM cuts WHERE cut >= 1),
steps AS (SELECT c.unique_id, c.win, c.cut, h.h FROM cuts1 c, generate_series(1, 24) AS h(h)),
how_src AS (SELECT s.unique_id, s.win, s.cut, s.h, s.cut + s.h - k.k * 168 AS sp
            FROM steps s, generate_series(1, 8) AS k(k)),
how AS (SELECT s.unique_id, s.win, s.cut, s.h, avg(p.y) AS v
        FROM how_src s LEFT JOIN panel p ON p.unique_id = s.unique_id AND p.pos = s.sp
        WHERE s.sp >= 1 GROUP BY 1, 2, 3, 4),
fb AS (SELECT c.unique_id, c.win, c.cut, avg(p.y) AS v
       FROM cuts1 c JOIN panel p ON p.unique_id = c.unique_id AND p.pos BETWEEN greatest(1, c.cut - 23) AND c.cut
       GROUP BY 1, 2, 3),
lastv AS (SELECT c.unique_id, c.win, c.cut, p.y AS v
          FROM cuts1 c LEFT JOIN panel p ON p.unique_id = c.unique_id AND p.pos = c.cut),
f5 AS (SELECT s.unique_id, s.win, s.cut, s.h, 'seasonal_how_average' AS model,
              coalesce(how.v, fb.v, lastv.v) AS y_pred
       FROM steps s LEFT JOIN how USING (unique_id, win, cut, h) LEFT JOIN fb USING (unique_id, win, cut)
       JOIN lastv USING (unique_id, win, cut)),
f2 AS (SELECT s.unique_id, s.win, s.cut, s.h, 'seasonal_naive_168' AS model, p.y AS y_pred
       FROM steps s LEFT JOIN panel p ON p.unique_id = s.unique_id
         AND p.pos = CASE WHEN s.cut < 168 THEN s.cut ELSE s.cut - 167 + (s.h - 1) % 168 END),
preds AS (SELECT f.*, p.ds, p.y, p.y - f.y_pred AS residual
          FROM (SELECT * FROM f5 UNION ALL SELECT * FROM f2) f
          LEFT JOIN panel p ON p.unique_id = f.unique_id AND p.pos = f.cut + f.h),
scale AS (SELECT unique_id, CASE WHEN m IS NOT NULL AND NOT isnan(m) AND m > 0 AND NOT isinf(m) THEN m ELSE 1.0 END AS s
          FROM (SELECT a.unique_id, avg(abs(a.y - b.y)) AS m
                FROM panel a LEFT JOIN panel b ON b.unique_id = a.unique_id AND b.pos = a.pos - 24 GROUP BY 1)),
bw AS (SELECT unique_id, model, win,
         avg(abs(y - y_pred)) AS mae, sqrt(avg((y - y_pred) * (y - y_pred))) AS rmse,
         avg(CASE WHEN abs(y) > 1e-8 THEN abs((y - y_pred) / y) END) * 100 AS mape,
         avg(CASE WHEN abs(y) + abs(y_pred) > 1e-8 THEN 2 * abs(y - y_pred) / (abs(y) + abs(y_pred)) END) * 100 AS smape
       FROM preds GROUP BY 1, 2, 3),
bw2 AS (SELECT bw.*, CASE WHEN scale.s > 0 THEN bw.mae / scale.s END AS mase FROM bw LEFT JOIN scale USING (unique_id)),
lb AS (SELECT unique_id, model, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape, avg(smape) AS smape,
              avg(mase) AS mase FROM bw2 GROUP BY 1, 2)"""


_CTE_NAMES = ["lens", "wc", "cuts1", "cuts", "steps", "how_src", "how", "fb", "lastv", "f5", "f2", "preds",
              "scale", "bw2", "bw", "lb"]


def pipeline_ctes(prefix: str = "") -> str:
    """``PIPELINE_CTES`` with every CTE name prefixed (to sit next to other CTEs)."""
    if not prefix:
        return PIPELINE_CTES
    return re.sub(r"\b(" + "|".join(_CTE_NAMES) + r")\b", lambda m: prefix + m.group(1), PIPELINE_CTES)


@register("pipeline_leaderboard", f"""
WITH {panel_sql('H')}, {PIPELINE_CTES}
SELECT unique_id, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY smape ASC NULLS LAST, model) AS BIGINT) AS rank,
       model, {R('mae rmse mape smape mase')}
FROM lb""")
def q_pipeline_leaderboard(spark, sf):
    _, _, board = PL.pipeline_backtest(prepared_panel(spark, sf, "H"))
    return rounded(board)


@register("pipeline_backtest_predictions", f"""
WITH {panel_sql('H')}, {PIPELINE_CTES}
SELECT unique_id, win AS "window", CAST(h AS BIGINT) AS horizon, ds, model, {R('y y_pred residual')} FROM preds""")
def q_pipeline_predictions(spark, sf):
    preds, _, _ = PL.pipeline_backtest(prepared_panel(spark, sf, "H"))
    return rounded(preds.select("unique_id", "window", "horizon", "ds", "model", "y", "y_pred", "residual"))


@register("pipeline_metrics_by_window", f"""
WITH {panel_sql('H')}, {PIPELINE_CTES}
SELECT unique_id, model, win AS "window", {R('mae rmse mape smape mase')} FROM bw2""")
def q_pipeline_by_window(spark, sf):
    _, bw, _ = PL.pipeline_backtest(prepared_panel(spark, sf, "H"))
    return rounded(bw.select("unique_id", "model", "window", "mae", "rmse", "mape", "smape", "mase"))
