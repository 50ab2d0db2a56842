"""R-1 and N-2 on a stream (Structured Streaming).

* ``stream_resample_mean`` — per-series step means with an event-time watermark
  (late rows within the watermark still update their bucket).
* ``iqr_bounds`` — the static side of N-2, computed from a table: hour-of-week
  median and the per-series residual bounds ``q1 - k·iqr``, ``q3 + k·iqr``.
* ``score_seasonal_iqr`` — stream-static join of stream buckets with those
  bounds; the flag rule is the batch rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tspanel.config import AnomalyConfig
from tspanel.operators.anomaly import hour_of_week_profile
from tspanel.operators.features import hour_of_week
from tspanel.operators.quantiles import exact_quantiles


def stream_resample_mean(events: DataFrame, id_col: str, ts_col: str, value_col: str,
                         step: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """Streaming R-1: ``unique_id, ds, y`` per (series, step bucket)."""
    ts = F.col(ts_col).cast("timestamp")
    return (events.withColumn("_ts", ts).withWatermark("_ts", watermark)
                  .groupBy(F.col(id_col).cast("string").alias("unique_id"), F.window("_ts", step).alias("_w"))
                  .agg(F.avg(value_col).alias("y"))
                  .select("unique_id", F.col("_w.start").alias("ds"), "y"))


def iqr_bounds(panel: DataFrame, config: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """Static N-2 model: ``unique_id, hour_of_week, seasonal_expected, lower, upper``."""
    prof = hour_of_week_profile(panel)
    resid = (panel.withColumn("hour_of_week", hour_of_week()).join(prof, ["unique_id", "hour_of_week"])
                  .withColumn("_r", F.col("y") - F.col("seasonal_expected")))
    q = exact_quantiles(resid, ["unique_id"], "_r", [0.25, 0.75], out="_q")
    k = F.lit(config.iqr_multiplier)
    q1, q3 = F.col("_q_0"), F.col("_q_1")
    return (prof.join(q, "unique_id")
                .select("unique_id", "hour_of_week", "seasonal_expected",
                        (q1 - k * (q3 - q1)).alias("lower"), (q3 + k * (q3 - q1)).alias("upper")))


def score_seasonal_iqr(stream_panel: DataFrame, bounds: DataFrame) -> DataFrame:
    """Stream-static join: seasonal residual and flag for every stream bucket."""
    d = stream_panel.withColumn("hour_of_week", hour_of_week("ds")).join(bounds, ["unique_id", "hour_of_week"], "left")
    r = F.col("y") - F.col("seasonal_expected")
    return d.select("unique_id", "ds", "y", "seasonal_expected", r.alias("seasonal_iqr_score"),
                    F.coalesce((r < F.col("lower")) | (r > F.col("upper")), F.lit(False)).alias("seasonal_iqr_anomaly"))
