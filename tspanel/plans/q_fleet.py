"""Queries of the statistical fleets (F-13..F-15) with SQL twins: the same search, rounds and all, by recursive queries."""

from __future__ import annotations

from tspanel.config import BacktestConfig
from tspanel.operators import baselines as B
from tspanel.operators import fleet as FL
from tspanel.plans.q_stats import BACKTEST_CUTS
from tspanel.plans.registry import register, rnd
from tspanel.plans.util import rounded
from tspanel.sources.panels import panel_sql, prepared_panel

_HISTORY = f"""
WITH RECURSIVE {panel_sql('H')}, cuts AS ({BACKTEST_CUTS}),
h AS MATERIALIZED (SELECT c.unique_id, c.win, c.cut, p.pos AS t, p.y FROM cuts c JOIN panel p ON p.unique_id = c.unique_id AND p.pos <= c.cut)"""


def _search(names: list[str], coarse: str, limits: list[tuple[float, float, float]], start: str, first: int, rows: str, step: str, state: str) -> str:
    """One recursive query a round. ``coarse``: points of the first round; ``limits``: lower end, upper end and first step of
    each parameter; ``start``: state and ``sse`` at ``first``, of ``{names}`` x ``rows``; ``step``: the same one row on."""
    cols, out = ", ".join(names), []
    for k in range(FL.ROUNDS + 1):
        if k == 0:
            points = f"SELECT cuts.unique_id, cuts.win, cuts.cut, {cols} FROM cuts CROSS JOIN ({coarse}) g"
        else:
            moved = ", ".join(f"least(greatest(b.p.{n} + m_{n}.m * {size / 2 ** (k - 1)!r}, {lo}), {hi}) AS {n}" for n, (lo, hi, size) in zip(names, limits))
            moves = " ".join(f"CROSS JOIN (VALUES (-1), (0), (1)) m_{n}(m)" for n in names)
            points = f"SELECT DISTINCT b.unique_id, b.win, b.cut, {moved} FROM best{k - 1} b {moves}"
        out.append(f"""
c{k} AS MATERIALIZED ({points}),
r{k} AS (
  SELECT c.unique_id, c.win, c.cut, {cols}, CAST({first} AS BIGINT) AS t, {start} FROM c{k} c JOIN {rows} x ON x.unique_id = c.unique_id AND x.win = c.win AND x.t = {first}
  UNION ALL
  SELECT r.unique_id, r.win, r.cut, {cols}, r.t + 1, {step} FROM r{k} r JOIN {rows} x ON x.unique_id = r.unique_id AND x.win = r.win AND x.t = r.t + 1),
best{k} AS MATERIALIZED (SELECT unique_id, win, cut, arg_min(struct_pack({", ".join(f"{n} := {n}" for n in [*names, *state.split()])}), sse) AS p FROM r{k} WHERE t = cut GROUP BY 1, 2, 3)""")
    return ",".join(out)


def _answer(model: str, value: str, extra: str = "") -> str:
    return f"""
SELECT b.unique_id, CAST(b.win AS BIGINT) AS "window", CAST(b.cut AS BIGINT) AS cut, CAST(i.i AS BIGINT) AS horizon, '{model}' AS model, {rnd(value)} AS y_pred
FROM best{FL.ROUNDS} b CROSS JOIN generate_series(1, 24) i(i) {extra}"""


def _forecasts(spark, sf, model):
    p, c = prepared_panel(spark, sf, "H"), BacktestConfig()
    cuts = B.backtest_cutoffs(p, c.horizon, c.n_windows, c.step, c.min_history)
    return rounded(FL.fleet_forecasts(p, cuts, models=(model,)).select("unique_id", "window", "cut", "horizon", "model", "y_pred"))


@register("manual_theta_backtest", f"""{_HISTORY},
e AS (SELECT *, y - avg(y) OVER (PARTITION BY unique_id, win) AS e FROM h),
lags AS (SELECT a.unique_id, a.win, any_value(a.cut) AS n, k.k, sum(a.e * b.e) AS s FROM e a CROSS JOIN generate_series(0, 24) k(k)
         JOIN e b ON b.unique_id = a.unique_id AND b.win = a.win AND b.t = a.t - k.k GROUP BY a.unique_id, a.win, k.k),
acf AS (SELECT unique_id, win, n, k, s / max(s) FILTER (WHERE k = 0) OVER (PARTITION BY unique_id, win) AS r FROM lags),
test AS (SELECT unique_id, win, abs(max(r) FILTER (WHERE k = 24)) / sqrt((1 + 2 * sum(r * r) FILTER (WHERE k BETWEEN 1 AND 23)) / any_value(n)) > {FL.SEASON_LIMIT} AS seasonal
         FROM acf GROUP BY 1, 2),
kind AS (SELECT unique_id, win, seasonal, min(y) > 0 AS mult FROM h JOIN test USING (unique_id, win) GROUP BY 1, 2, 3),
mid AS (SELECT unique_id, win, t, y, CASE WHEN count(y) OVER z = 25 THEN (sum(y) OVER z - 0.5 * (lag(y, 12) OVER o + lead(y, 12) OVER o)) / 24.0 END AS trend FROM h
        WINDOW o AS (PARTITION BY unique_id, win ORDER BY t), z AS (PARTITION BY unique_id, win ORDER BY t ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING)),
ph AS (SELECT unique_id, win, seasonal, mult, (t - 1) % 24 AS ph, avg(CASE WHEN mult THEN y / trend ELSE y - trend END) AS m
       FROM mid JOIN kind USING (unique_id, win) WHERE trend IS NOT NULL GROUP BY 1, 2, 3, 4, 5),
idx AS MATERIALIZED (SELECT unique_id, win, ph, mult, CASE WHEN NOT seasonal THEN CAST(mult AS INT) WHEN mult THEN m / avg(m) OVER (PARTITION BY unique_id, win)
                     ELSE m - avg(m) OVER (PARTITION BY unique_id, win) END AS s FROM ph),
x AS MATERIALIZED (SELECT h.unique_id, h.win, h.cut, h.t, CASE WHEN mult THEN y / s ELSE y - s END AS v, CASE WHEN mult THEN s ELSE 1.0 END AS wt
      FROM h JOIN idx ON idx.unique_id = h.unique_id AND idx.win = h.win AND idx.ph = (h.t - 1) % 24),
line AS (SELECT unique_id, win, regr_slope(v, CAST(t AS DOUBLE)) AS slope FROM x GROUP BY 1, 2),"""
          + _search(["a"], "SELECT 0.01 + i * 0.98 / 11 AS a FROM generate_series(0, 11) s(i)", [(0.001, 0.999, 0.05)],
                    "x.v AS level, CAST(0 AS DOUBLE) AS sse", 1, "x", "r.level + a * (x.v - r.level), r.sse + ((x.v - r.level) * x.wt) ** 2", "level")
          + _answer("manual_theta_24", "CASE WHEN mult THEN (b.p.level + slope / 2 * (i.i - 1 + (1 - (1 - b.p.a) ** b.cut) / b.p.a)) * s"
                    " ELSE b.p.level + slope / 2 * (i.i - 1 + (1 - (1 - b.p.a) ** b.cut) / b.p.a) + s END",
                    "JOIN line USING (unique_id, win) JOIN idx ON idx.unique_id = b.unique_id AND idx.win = b.win AND idx.ph = (b.cut + i.i - 1) % 24"))
def q_theta(spark, sf):
    """F-14: seasonal indices, half the slope and the smoothed level, for every (series, window)."""
    return _forecasts(spark, sf, "manual_theta_24")


_GRID = "SELECT -0.9 + i * 1.8 / 11 AS {n} FROM generate_series(0, 11) s(i)"


@register("manual_arima_backtest", f"""{_HISTORY},
d AS (SELECT unique_id, win, cut, t, y, y - lag(y) OVER (PARTITION BY unique_id, win ORDER BY t) AS w FROM h),
x AS MATERIALIZED (SELECT *, lag(w) OVER (PARTITION BY unique_id, win ORDER BY t) AS before FROM d),"""
          + _search(["f", "g"], f"SELECT f, g FROM ({_GRID.format(n='f')}) CROSS JOIN ({_GRID.format(n='g')})", [(-0.995, 0.995, 0.08)] * 2,
                    "CAST(0 AS DOUBLE) AS e, CAST(0 AS DOUBLE) AS sse", 2, "x", "x.w - f * x.before - g * r.e, r.sse + (x.w - f * x.before - g * r.e) ** 2", "e")
          # the steps are a geometric series from the first one on
          + _answer("manual_arima", "x.y + (b.p.f * x.w + b.p.g * b.p.e) * CASE WHEN b.p.f = 1 THEN i.i ELSE (1 - b.p.f ** i.i) / (1 - b.p.f) END",
                    "JOIN x ON x.unique_id = b.unique_id AND x.win = b.win AND x.t = b.cut"))
def q_arima(spark, sf):
    """F-15: ARIMA(1,1,1) by conditional sum of squares, for every (series, window)."""
    return _forecasts(spark, sf, "manual_arima")


_OLD = "r.terms[(x.t - 1) % 24 + 1]"
_ERR = f"(x.y - r.level - r.slope - {_OLD})"


@register("manual_ets_backtest", f"""{_HISTORY},
head AS (SELECT unique_id, win, avg(y) FILTER (WHERE t <= 24) AS l0, avg(y) FILTER (WHERE t > 24) AS l1, list(y ORDER BY t) FILTER (WHERE t <= 24) AS ys
         FROM h WHERE t <= 48 GROUP BY 1, 2),
x AS MATERIALIZED (SELECT h.*, l0, (l1 - l0) / 24 AS b0, list_transform(ys, lambda v: v - l0) AS s0 FROM h JOIN head USING (unique_id, win)),"""
          + _search(["a", "b", "c"], "SELECT a, b, c FROM (VALUES (0.02), (0.25), (0.5), (0.75), (0.98)) q(a), (VALUES (0.0), (0.15), (0.4)) u(b), (VALUES (0.0), (0.3), (0.6), (0.9)) v(c)",
                    [(0.001, 0.999, 0.12), (0.0, 0.999, 0.12), (0.0, 0.999, 0.15)], "x.l0 AS level, x.b0 AS slope, x.s0 AS terms, CAST(0 AS DOUBLE) AS sse", 24, "x",
                    f"r.level + r.slope + a * {_ERR}, r.slope + a * b * {_ERR}, "
                    f"list_concat(r.terms[1:(x.t - 1) % 24], [{_OLD} + c * {_ERR}], r.terms[(x.t - 1) % 24 + 2:24]), r.sse + {_ERR} ** 2", "level slope terms")
          + _answer("manual_ets_additive", "b.p.level + i.i * b.p.slope + b.p.terms[(b.cut + i.i - 1) % 24 + 1]"))
def q_ets(spark, sf):
    """F-13: additive trend and season, for every (series, window)."""
    return _forecasts(spark, sf, "manual_ets_additive")
