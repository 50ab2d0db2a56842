"""Queries: calendar / lag / rolling features and rule-based anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tspanel.config import AnomalyConfig, FeatureConfig
from tspanel.operators import anomaly as N
from tspanel.operators import features as FT
from tspanel.plans.registry import R, register, rnd
from tspanel.plans.util import BIAS, rounded
from tspanel.sources.panels import panel, panel_sql, prepared_panel

PART = "PARTITION BY unique_id ORDER BY pos"


def frame(lo: int, hi: int) -> str:
    """SQL window with ROWS frame [lo, hi] relative to the current row."""
    def edge(k: int) -> str:
        if k == 0:
            return "CURRENT ROW"
        return f"{-k} PRECEDING" if k < 0 else f"{k} FOLLOWING"
    return f"({PART} ROWS BETWEEN {edge(lo)} AND {edge(hi)})"


def guarded(fn: str, lo: int, hi: int, mp: int, value: str = "y") -> str:
    f = frame(lo, hi)
    return f"CASE WHEN count({value}) OVER {f} >= {mp} THEN {fn}({value}) OVER {f} END"


CAL_SQL = """CAST(hour(ds) AS BIGINT) AS hour, CAST(isodow(ds) - 1 AS BIGINT) AS dayofweek, CAST(month(ds) AS BIGINT) AS month,
  CAST(CASE WHEN isodow(ds) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
  {hs} AS hour_sin, {hc} AS hour_cos, {ws} AS dow_sin, {wc} AS dow_cos""".format(
    hs=rnd("sin(6.283185307179586 * hour(ds) / 24.0)"), hc=rnd("cos(6.283185307179586 * hour(ds) / 24.0)"),
    ws=rnd("sin(6.283185307179586 * (isodow(ds) - 1) / 7.0)"), wc=rnd("cos(6.283185307179586 * (isodow(ds) - 1) / 7.0)"))


def _feature_sql(cfg: FeatureConfig = FeatureConfig()) -> str:
    cols = [f"{rnd(f'lag(y, {k}) OVER ({PART})')} AS lag_{k}" for k in cfg.lags]
    for w in cfg.rolling_windows:
        mp = max(2, w // 4)
        for s, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            cols.append(f"{rnd(guarded(fn, -w, -1, mp))} AS rolling_{s}_{w}")
    return ",\n  ".join(cols)


# ---------------------------------------------------------------- X-1, X-2, X-4, W-1, W-2, F-18

@register("forecast_features", f"""
WITH {panel_sql('H')}
SELECT unique_id, ds, {rnd('y')} AS y, pos, {CAL_SQL},
  {_feature_sql()}
FROM panel""")
def q_forecast_features(spark, sf):
    """F-18: the 25-column feature matrix on the hourly panel."""
    return rounded(FT.forecast_features(prepared_panel(spark, sf, "H")))


@register("lag_features_daily", f"""
WITH {panel_sql('D')}
SELECT unique_id, ds, pos, {R('y')},
  {rnd(f'lag(y, 1) OVER ({PART})')} AS lag_1, {rnd(f'lag(y, 7) OVER ({PART})')} AS lag_7,
  {rnd(f'lag(y, 28) OVER ({PART})')} AS lag_28
FROM panel""")
def q_lags_daily(spark, sf):
    """W-1 on the daily orders panel."""
    return rounded(FT.add_lags(prepared_panel(spark, sf, "D"), [1, 7, 28]))


# ---------------------------------------------------------------- W-3, W-6, W-7

@register("rolling_means", f"""
WITH {panel_sql('H')}
SELECT unique_id, ds, pos, {R('y')},
  {rnd(guarded('avg', -23, 0, 8))} AS rolling_mean_24,
  {rnd(guarded('avg', -167, 0, 56))} AS rolling_mean_168
FROM panel""")
def q_rolling_means(spark, sf):
    return rounded(FT.add_rolling_means(prepared_panel(spark, sf, "H"), (24, 168)))


@register("differences", f"""
WITH {panel_sql('H')}
SELECT unique_id, ds, pos, {R('y')},
  {rnd(f'y - lag(y, 1) OVER ({PART})')} AS diff_1, {rnd(f'y - lag(y, 24) OVER ({PART})')} AS diff_24
FROM panel""")
def q_differences(spark, sf):
    return rounded(FT.add_differences(prepared_panel(spark, sf, "H"), 24))


# ---------------------------------------------------------------- W-4, N-1

@register("rolling_median_std", f"""
WITH {panel_sql('H')}
SELECT unique_id, ds, pos, {R('y')},
  {rnd(guarded('median', -167, 0, 84))} AS rolling_median_168,
  {rnd(guarded('stddev_samp', -167, 0, 84))} AS rolling_std_168
FROM panel""")
def q_rolling_median(spark, sf):
    return rounded(FT.add_rolling_median_std(prepared_panel(spark, sf, "H"), 168))


ZSCORE_SQL = f"""
rz AS (SELECT unique_id, ds, pos, y,
         (y - {guarded('median', -167, 0, 84)}) / nullif({guarded('stddev_samp', -167, 0, 84)}, 0) AS score
       FROM panel),
zs AS (SELECT unique_id, ds, pos, score AS rolling_z_score, coalesce(abs(score) > 3.5, false) AS rolling_z_anomaly FROM rz)"""


@register("anomaly_rolling_zscore", f"""
WITH {panel_sql('H')}, {ZSCORE_SQL}
SELECT unique_id, ds, pos, {R('rolling_z_score')}, rolling_z_anomaly FROM zs""")
def q_zscore(spark, sf):
    return rounded(N.rolling_zscore(prepared_panel(spark, sf, "H")))


# ---------------------------------------------------------------- A-8, A-9, J-2, N-2

IQR_SQL = """
d_how AS (SELECT unique_id, ds, pos, y, (isodow(ds) - 1) * 24 + hour(ds) AS how FROM panel),
prof AS (SELECT unique_id, how, quantile_cont(y, 0.5) AS seasonal_expected FROM d_how GROUP BY 1, 2),
resid AS (SELECT d.unique_id, d.ds, d.pos, p.seasonal_expected, d.y - p.seasonal_expected AS r
          FROM d_how d LEFT JOIN prof p USING (unique_id, how)),
qr AS (SELECT unique_id, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.75) AS q3 FROM resid GROUP BY 1),
iq AS (SELECT s.unique_id, s.ds, s.pos, s.seasonal_expected, s.r AS seasonal_iqr_score,
              coalesce(s.r < q.q1 - 3.0 * (q.q3 - q.q1) OR s.r > q.q3 + 3.0 * (q.q3 - q.q1), false) AS seasonal_iqr_anomaly
       FROM resid s LEFT JOIN qr q USING (unique_id))"""


@register("hour_of_week_profile", f"""
WITH {panel_sql('H')}, {IQR_SQL}
SELECT unique_id, CAST(how AS BIGINT) AS hour_of_week, {R('seasonal_expected')} FROM prof""")
def q_how_profile(spark, sf):
    return rounded(N.hour_of_week_profile(prepared_panel(spark, sf, "H")))


@register("anomaly_seasonal_iqr", f"""
WITH {panel_sql('H')}, {IQR_SQL}
SELECT unique_id, ds, pos, {R('seasonal_expected seasonal_iqr_score')}, seasonal_iqr_anomaly FROM iq""")
def q_iqr(spark, sf):
    return rounded(N.seasonal_iqr(prepared_panel(spark, sf, "H")))


# ---------------------------------------------------------------- N-5, A-10 (rule detectors)

COMBINED_SQL = f"""{ZSCORE_SQL}, {IQR_SQL},
comb AS (SELECT p.unique_id, p.ds, p.pos, p.y, z.rolling_z_score, coalesce(z.rolling_z_anomaly, false) AS rolling_z_anomaly,
                i.seasonal_expected, i.seasonal_iqr_score, coalesce(i.seasonal_iqr_anomaly, false) AS seasonal_iqr_anomaly
         FROM panel p LEFT JOIN zs z USING (unique_id, pos) LEFT JOIN iq i USING (unique_id, pos))"""


@register("anomaly_combined_rules", f"""
WITH {panel_sql('H')}, {COMBINED_SQL}
SELECT unique_id, ds, pos, {R('y rolling_z_score seasonal_expected seasonal_iqr_score')},
       rolling_z_anomaly, seasonal_iqr_anomaly,
       CAST(CAST(rolling_z_anomaly AS INTEGER) + CAST(seasonal_iqr_anomaly AS INTEGER) AS BIGINT) AS anomaly_votes,
       seasonal_iqr_anomaly AS selected_anomaly
FROM comb""")
def q_combined(spark, sf):
    """N-5 with the two rule detectors (isolation forest is a separate R check)."""
    out = N.combine(prepared_panel(spark, sf, "H"), AnomalyConfig())
    return rounded(out.select("unique_id", "ds", "pos", "y", "rolling_z_score", "seasonal_expected",
                              "seasonal_iqr_score", "rolling_z_anomaly", "seasonal_iqr_anomaly",
                              F.col("anomaly_votes").cast("bigint").alias("anomaly_votes"), "selected_anomaly"))


@register("anomaly_summary_rules", f"""
WITH {panel_sql('H')}, {COMBINED_SQL}
SELECT unique_id, method, CAST(anomalies AS BIGINT) AS anomalies, round(anomalies / n * 100.0 + 3.3e-9, 3) AS share_percent FROM (
  SELECT unique_id, 'rolling_z_score' AS method, count(*) FILTER (WHERE rolling_z_anomaly) AS anomalies, count(*) AS n FROM comb GROUP BY 1
  UNION ALL SELECT unique_id, 'seasonal_iqr', count(*) FILTER (WHERE seasonal_iqr_anomaly), count(*) FROM comb GROUP BY 1
  UNION ALL SELECT unique_id, 'selected_method', count(*) FILTER (WHERE seasonal_iqr_anomaly), count(*) FROM comb GROUP BY 1)""")
def q_summary_rules(spark, sf):
    comb = N.combine(prepared_panel(spark, sf, "H"), AnomalyConfig())
    methods = {k: v for k, v in N.FLAG_COLUMNS.items() if k != "isolation_forest"}
    return N.summary(comb, methods, None).withColumn("share_percent", F.round(F.col("share_percent") + F.lit(BIAS), 3))


# ---------------------------------------------------------------- N-3, W-10

@register("isolation_features", f"""
WITH {panel_sql('H')}
SELECT unique_id, ds, pos, {R('y')},
  {rnd(f'lag(y, 1) OVER ({PART})')} AS lag_1, {rnd(f'lag(y, 24) OVER ({PART})')} AS lag_24,
  {rnd(f'lag(y, 168) OVER ({PART})')} AS lag_168,
  {rnd(guarded('avg', -24, -1, 12))} AS rolling_mean_24, {rnd(guarded('stddev_samp', -24, -1, 12))} AS rolling_std_24,
  {rnd(guarded('avg', -168, -1, 48))} AS rolling_mean_168,
  CAST(hour(ds) AS BIGINT) AS hour, CAST(isodow(ds) - 1 AS BIGINT) AS dayofweek, CAST(month(ds) AS BIGINT) AS month
FROM panel""")
def q_isolation_features(spark, sf):
    return rounded(FT.isolation_features(prepared_panel(spark, sf, "H")))


@register("short_lag_features", f"""
WITH {panel_sql('L')}, f AS (
SELECT unique_id, ds, pos, y,
  lag(y, 1) OVER ({PART}) AS lag_1, lag(y, 2) OVER ({PART}) AS lag_2, lag(y, 3) OVER ({PART}) AS lag_3,
  lag(y, 7) OVER ({PART}) AS lag_7, lag(y, 14) OVER ({PART}) AS lag_14,
  {guarded('avg', -7, -1, 7)} AS rolling_mean_7, {guarded('stddev_samp', -7, -1, 7)} AS rolling_std_7,
  {guarded('avg', -14, -1, 14)} AS rolling_mean_14, {guarded('stddev_samp', -14, -1, 14)} AS rolling_std_14,
  {guarded('avg', -30, -1, 30)} AS rolling_mean_30, {guarded('stddev_samp', -30, -1, 30)} AS rolling_std_30,
  CAST(isodow(ds) - 1 AS BIGINT) AS dayofweek, CAST(month(ds) AS BIGINT) AS month, CAST(day(ds) AS BIGINT) AS day,
  CAST(CASE WHEN isodow(ds) - 1 >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend
FROM panel)
SELECT unique_id, ds, pos, {R('y lag_1 lag_2 lag_3 lag_7 lag_14 rolling_mean_7 rolling_std_7 rolling_mean_14 rolling_std_14 rolling_mean_30 rolling_std_30')},
  dayofweek, month, day, is_weekend
FROM f WHERE y IS NOT NULL AND lag_14 IS NOT NULL AND rolling_std_30 IS NOT NULL AND rolling_std_14 IS NOT NULL
  AND rolling_std_7 IS NOT NULL AND rolling_mean_30 IS NOT NULL""")
def q_short_lags(spark, sf):
    """W-10 on the daily lineitem panel."""
    return rounded(FT.short_lag_features(prepared_panel(spark, sf, "L")))
