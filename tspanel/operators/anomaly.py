"""Anomaly detection (N-1..N-5, A-8..A-10, J-2, P-7, P-8).

Rule-based detectors are window / aggregate plans; the isolation forest lives
in ``isolation.py`` (tree building is a bounded group-map job).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tspanel.config import AnomalyConfig
from tspanel.operators import features as FT
from tspanel.operators.prepare import flag_or_false, zero_to_null
from tspanel.operators.quantiles import exact_quantiles

FLAG_COLUMNS = {"rolling_z_score": "rolling_z_anomaly", "seasonal_iqr": "seasonal_iqr_anomaly",
                "isolation_forest": "isolation_anomaly", "selected_method": "selected_anomaly"}


def rolling_zscore(panel: DataFrame, config: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """N-1: ``(y - rolling median) / rolling std`` over ``rolling_window`` rows
    (current included, ``min_periods = w // 2``); std 0 → NULL score; flag
    ``|score| > threshold``, NULL score → False."""
    w = config.rolling_window
    feats = FT.add_rolling_median_std(panel.select("unique_id", "ds", "pos", "y"), w)
    score = (F.col("y") - F.col(f"rolling_median_{w}")) / zero_to_null(F.col(f"rolling_std_{w}"))
    return feats.select("unique_id", "ds", "pos", score.alias("rolling_z_score"),
                        flag_or_false(F.abs(score) > F.lit(config.rolling_z_threshold)).alias("rolling_z_anomaly"))


def hour_of_week_profile(panel: DataFrame) -> DataFrame:
    """A-8: median ``y`` per (series, hour of week)."""
    d = panel.withColumn("hour_of_week", FT.hour_of_week())
    return exact_quantiles(d, ["unique_id", "hour_of_week"], "y", [0.5], out="_q").withColumnRenamed(
        "_q_0", "seasonal_expected")


def seasonal_iqr(panel: DataFrame, config: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """N-2: residual from the hour-of-week median (J-2), flagged outside
    ``[q1 - k·iqr, q3 + k·iqr]`` of the series' residual quartiles (A-9)."""
    prof = hour_of_week_profile(panel)
    d = (panel.select("unique_id", "ds", "pos", "y").withColumn("hour_of_week", FT.hour_of_week())
              .join(prof, ["unique_id", "hour_of_week"], "left")
              .withColumn("seasonal_iqr_score", F.col("y") - F.col("seasonal_expected")))
    q = exact_quantiles(d, ["unique_id"], "seasonal_iqr_score", [0.25, 0.75], out="_q")
    k = F.lit(config.iqr_multiplier)
    q1, q3 = F.col("_q_0"), F.col("_q_1")
    lower, upper = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
    r = F.col("seasonal_iqr_score")
    return (d.join(q, "unique_id", "left")
             .select("unique_id", "ds", "pos", "seasonal_expected", "seasonal_iqr_score",
                     flag_or_false((r < lower) | (r > upper)).alias("seasonal_iqr_anomaly")))


def combine(panel: DataFrame, config: AnomalyConfig = AnomalyConfig(), isolation: DataFrame | None = None) -> DataFrame:
    """N-5: one row per panel row with all scores, flags, votes and the
    selected flag (= seasonal IQR). Detectors are joined on (unique_id, pos)."""
    keys = ["unique_id", "pos"]
    out = (panel.select("unique_id", "ds", "y", "pos")
                .join(rolling_zscore(panel, config).drop("ds"), keys, "left")
                .join(seasonal_iqr(panel, config).drop("ds"), keys, "left"))
    if isolation is not None:
        out = out.join(isolation.select("unique_id", "pos", "isolation_score", "isolation_anomaly"), keys, "left")
    else:
        out = out.withColumn("isolation_score", F.lit(None).cast("double")).withColumn("isolation_anomaly", F.lit(None).cast("boolean"))
    flags = ["rolling_z_anomaly", "seasonal_iqr_anomaly", "isolation_anomaly"]
    out = out.withColumns({c: flag_or_false(F.col(c)) for c in flags})
    votes = sum((F.col(c).cast("int") for c in flags), F.lit(0))
    return out.withColumn("anomaly_votes", votes).withColumn("selected_anomaly", F.col("seasonal_iqr_anomaly"))


def summary(anomalies: DataFrame, methods: dict[str, str] = FLAG_COLUMNS, digits: int | None = 3) -> DataFrame:
    """A-10: per series and method, flagged count and share in percent (rounded to ``digits``; None: as it is)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(F.col(c)).alias(m) for m, c in methods.items()]
    wide = anomalies.groupBy("unique_id").agg(*aggs)
    long = wide.unpivot(["unique_id", "_n"], list(methods), "method", "anomalies")
    share = F.try_divide(F.col("anomalies"), F.col("_n")) * F.lit(100.0)
    share = share if digits is None else F.round(share, digits)
    return long.select("unique_id", "method", "anomalies", share.alias("share_percent"))
