"""Diagnostics and statistical tests (D-1..D-8, K-1; D-9 and D-10 are in ``stationarity``).

Every test is distributed sums over the series followed by a tiny closed form
on one row per series. Residual tables of a backtest hold at most
``windows × horizon`` rows per (series, model), so windows over them are
bounded; windows over whole series use the halo layout.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tspanel.functions import stats_math as SM
from tspanel.operators import windowing as hw
from tspanel.operators.prepare import last_n, row_numbers
from tspanel.operators.stationarity import stationarity_tests  # noqa: F401

# ---------------------------------------------------------------- residual tables


def residual_sequence(preds: DataFrame, keys: tuple[str, ...] = ("unique_id", "model")) -> DataFrame:
    """Residuals in window order: ``seq`` 1..k per key (bounded partitions)."""
    w = Window.partitionBy(*keys).orderBy("window", "horizon")
    return (preds.withColumn("residual", F.col("y") - F.col("y_pred"))
                 .withColumn("seq", F.row_number().over(w)))


def residual_diagnostics(preds: DataFrame, best: DataFrame, lag: int = 24) -> DataFrame:
    """D-1..D-4 for each series' chosen model: mean, std (ddof 0), MAE, median,
    lag-1 Pearson autocorrelation, 80/95 coverage (NULL without bands),
    Ljung-Box p-value at ``lag`` (χ² with even df in closed form). The
    residuals of one (series, model) are bounded by windows × horizon, so one
    aggregation gathers them and the Ljung-Box sum runs on the ordered array."""
    res = residual_sequence(preds.join(best.select("unique_id", "model"), ["unique_id", "model"], "left_semi"))
    w = Window.partitionBy("unique_id", "model").orderBy("seq")
    res = res.withColumn("_prev", F.lag("residual").over(w))
    r = F.col("residual")

    def cover(level: int) -> Column:
        inside = F.coalesce((F.col("y") >= F.col(f"lower_{level}")) & (F.col("y") <= F.col(f"upper_{level}")), F.lit(False))
        has = F.count(F.col(f"lower_{level}")) > 0
        return F.when(has & (F.count(F.col(f"upper_{level}")) > 0), F.avg(inside.cast("double")))

    base = res.groupBy("unique_id", "model").agg(
        F.avg(r).alias("residual_mean"), F.stddev_pop(r).alias("residual_std"), F.avg(F.abs(r)).alias("residual_mae"),
        F.percentile(r, 0.5).alias("residual_median"), F.corr(r, F.col("_prev")).alias("residual_lag1_autocorr"),
        cover(80).alias("coverage_80"), cover(95).alias("coverage_95"),
        F.array_sort(F.collect_list(F.when(r.isNotNull(), F.struct("seq", "residual")))).alias("_s"))
    base = with_ljung_box(base.withColumn("_arr", F.transform("_s", lambda x: x["residual"])), "_arr", F.lit(lag), "_q")
    q = F.col("_q")
    p = SM.chi2_sf_even_expr(q, lag) if lag % 2 == 0 else SM.chi2_sf_col(q, F.lit(float(lag)))
    return base.withColumn("ljung_box_pvalue", F.when(F.size("_arr") > lag, p)).drop("_s", "_arr", "_q", "_lag")


def with_ljung_box(df: DataFrame, arr: str, lag: Column, out: str = "_q") -> DataFrame:
    """Ljung-Box Q of an ordered residual array column (bounded: windows ×
    horizon values), JVM-side, in staged projections so the mean, the centred
    array and each lag sum are evaluated once per row."""
    n = F.size(arr)
    df = df.withColumn("_lbn", n.cast("double")).withColumn("_lag", lag)
    df = df.withColumn("_lbm", F.try_divide(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x), F.col("_lbn")))
    df = df.withColumn("_lbe", F.transform(arr, lambda x: x - F.col("_lbm")))
    df = df.withColumn("_lbc0", F.aggregate("_lbe", F.lit(0.0), lambda acc, x: acc + x * x))
    e = F.col("_lbe")
    df = df.withColumn("_lbck", F.transform(
        F.sequence(F.lit(1), F.greatest(F.col("_lag"), F.lit(1))),
        lambda k: F.aggregate(F.sequence(k + 1, F.greatest(n, k + 1)), F.lit(0.0),
                              lambda acc, t: acc + F.coalesce(F.try_element_at(e, t) * F.try_element_at(e, t - k),
                                                              F.lit(0.0)))))
    r2 = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("_lag"), F.lit(1))), F.lit(0.0),
                     lambda acc, k: acc + F.try_divide(F.pow(F.try_divide(F.element_at("_lbck", k), F.col("_lbc0")), 2),
                                                       F.col("_lbn") - k))
    df = df.withColumn(out, F.when(F.col("_lag") >= 1, F.col("_lbn") * (F.col("_lbn") + F.lit(2.0)) * r2))
    return df.drop("_lbn", "_lbm", "_lbe", "_lbc0", "_lbck")


def pipeline_tests(preds: DataFrame, final_model: str = "seasonal_how_average",
                   base_model: str = "seasonal_naive_168", with_pvalues: bool = True) -> DataFrame:
    """D-4..D-6 of the final pipeline per series: bias t-test (n ≥ 10), Ljung-Box
    at ``min(24, max(1, n // 3))`` (n ≥ 30), paired t-test of absolute errors
    against the baseline (equal counts, n ≥ 10).

    Residuals of a series are bounded by windows × horizon, so one aggregation
    per series gathers them (ordered by window, step) and every statistic is a
    projection. Returns ``unique_id, test, statistic, pvalue, status``."""
    r = F.col("y") - F.col("y_pred")
    pair = (preds.filter(F.col("model").isin(final_model, base_model))
                 .groupBy("unique_id", "window", "horizon")
                 .agg(F.max(F.when(F.col("model") == final_model, r)).alias("_rf"),
                      F.max(F.when(F.col("model") == base_model, r)).alias("_rb")))
    both = F.col("_rf").isNotNull() & F.col("_rb").isNotNull()
    d = F.when(both, F.abs("_rf") - F.abs("_rb"))
    per = pair.groupBy("unique_id").agg(
        F.count("_rf").alias("n_f"), F.avg("_rf").alias("m_f"), F.stddev_samp("_rf").alias("s_f"),
        F.count("_rb").alias("n_b"), F.count(d).alias("n_d"), F.avg(d).alias("m_d"), F.stddev_samp(d).alias("s_d"),
        F.avg(F.when(both, F.abs("_rf"))).alias("ma"), F.avg(F.when(both, F.abs("_rb"))).alias("mb"),
        F.array_sort(F.collect_list(F.when(F.col("_rf").isNotNull(),
                                           F.struct("window", "horizon", "_rf")))).alias("_s"))
    arr = F.transform("_s", lambda x: x["_rf"])
    lag = F.least(F.lit(24), F.greatest(F.lit(1), F.floor(F.col("n_f") / 3))).cast("int")
    t_bias = F.try_divide(F.col("m_f"), F.try_divide(F.col("s_f"), F.sqrt(F.col("n_f"))))
    t_pair = F.try_divide(F.col("m_d"), F.try_divide(F.col("s_d"), F.sqrt(F.col("n_d"))))
    stats = with_ljung_box(per.withColumn("_arr", arr), "_arr", lag, "_q")
    stats = stats.select("unique_id", "n_f", "n_b", "n_d", "ma", "mb", "_lag", t_bias.alias("_tb"),
                         t_pair.alias("_tp"), "_q")
    rows = F.array(
        F.struct(F.lit("bias_ttest").alias("test"), F.col("_tb").alias("statistic"),
                 (F.col("n_f") - 1).cast("double").alias("df"), F.lit("t").alias("dist"),
                 F.lit(None).cast("boolean").alias("_ok"), (F.col("n_f") >= 10).alias("_use")),
        F.struct(F.concat(F.lit("ljung_box_lag_"), F.col("_lag").cast("string")).alias("test"), F.col("_q").alias("statistic"),
                 F.col("_lag").cast("double").alias("df"), F.lit("chi2").alias("dist"),
                 F.lit(None).cast("boolean").alias("_ok"), (F.col("n_f") >= 30).alias("_use")),
        F.struct(F.lit("paired_ttest_vs_seasonal_naive_168").alias("test"), F.col("_tp").alias("statistic"),
                 (F.col("n_d") - 1).cast("double").alias("df"), F.lit("t").alias("dist"),
                 (F.col("ma") <= F.col("mb")).alias("_ok"),
                 ((F.col("n_f") == F.col("n_b")) & (F.col("n_d") >= 10)).alias("_use")))
    out = stats.select("unique_id", F.explode(rows).alias("_r")).select("unique_id", "_r.*").filter("_use")
    if with_pvalues:
        pv = F.when(F.col("dist") == "t", SM.t_two_sided_col(F.col("statistic"), F.col("df"))).otherwise(
            SM.chi2_sf_col(F.col("statistic"), F.col("df")))
        status = F.when(F.col("_ok").isNotNull(), F.when(F.col("_ok"), "pass").otherwise("warn")).otherwise(
            F.when(pv >= 0.05, "pass").otherwise("warn"))
        out = out.withColumn("pvalue", pv).withColumn("status", status)
    else:
        out = out.withColumn("pvalue", F.lit(None).cast("double")).withColumn(
            "status", F.when(F.col("_ok").isNotNull(), F.when(F.col("_ok"), "pass").otherwise("warn")))
    return out.select("unique_id", "test", "statistic", "pvalue", "status")


# ---------------------------------------------------------------- ACF / PACF (D-7, D-8)

def acf(panel: DataFrame, nlags: int = 72, max_points: int | None = None) -> DataFrame:
    """D-7: biased ACF (``Σ e_t e_{t-k} / Σ e_t²``) for k = 0..nlags on the non-null
    rows (the last ``max_points`` if given), lags counted in rows. Lag products
    come from the halo layout (one sort).
    Returns ``unique_id, lag, acf``."""
    d = panel.select("unique_id", "pos", "y").filter(F.col("y").isNotNull())
    if max_points is not None:
        d = last_n(d, max_points)
    d = row_numbers(d, "_i").drop("pos").withColumnRenamed("_i", "pos")
    mean = d.groupBy("unique_id").agg(F.avg("y").alias("_m"))
    d = d.join(mean, "unique_id").withColumn("_e", F.col("y") - F.col("_m"))
    w = hw.series_window()
    cols = {f"_p{k}": F.col("_e") * F.lag("_e", k).over(w) for k in range(1, nlags + 1)}
    prods = hw.rolling(d, cols, behind=nlags)
    sums = prods.groupBy("unique_id").agg(F.sum(F.col("_e") * F.col("_e")).alias("_p0"),
                                          *[F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, nlags + 1)])
    long = sums.unpivot(["unique_id"], [f"_p{k}" for k in range(nlags + 1)], "_name", "_s")
    c0 = sums.select("unique_id", F.col("_p0").alias("_c0"))
    return (long.join(c0, "unique_id")
                .select("unique_id", F.regexp_extract("_name", r"(\d+)", 1).cast("int").alias("lag"),
                        F.try_divide(F.col("_s"), F.col("_c0")).alias("acf")))


def pacf_from_acf(acf_df: DataFrame) -> DataFrame:
    """D-8: Yule-Walker (biased) PACF by Durbin-Levinson, per series on its
    ACF rows (nlags + 1 rows per group: bounded)."""

    def dl(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        r = pdf["acf"].to_numpy(dtype=float)
        m = len(r) - 1
        out = np.full(m + 1, np.nan)
        out[0] = 1.0
        phi = np.zeros(m + 1)
        v = r[0]
        for k in range(1, m + 1):
            a = (r[k] - np.dot(phi[1:k], r[1:k][::-1])) / v if v != 0 else np.nan
            new = phi.copy()
            new[k] = a
            for j in range(1, k):
                new[j] = phi[j] - a * phi[k - j]
            phi = new
            v = v * (1 - a * a)
            out[k] = a
        return pd.DataFrame({"unique_id": pdf["unique_id"].iloc[0], "lag": np.arange(m + 1), "pacf": out})

    return acf_df.groupBy("unique_id").applyInPandas(dl, "unique_id string, lag int, pacf double")


# ---------------------------------------------------------------- decomposition (K-1)

def decompose(panel: DataFrame, period: int = 24, max_points: int | None = None) -> DataFrame:
    """K-1: classical additive decomposition (of the last ``max_points`` rows if given).

    Centred moving average (2×period for even periods), ends extrapolated
    linearly from the nearest ``period`` trend values, phase means of the
    detrended series centred to zero, residual = y - trend - seasonal.
    Returns ``unique_id, ds, pos, y, trend, seasonal, resid``.
    """
    d = panel.select("unique_id", "ds", "pos", "y")
    if max_points is not None:
        d = last_n(d, max_points)
    start = d.groupBy("unique_id").agg(F.min("pos").alias("_p0"), F.max("pos").alias("_p1"))
    d = d.join(start, "unique_id").withColumn("_i", F.col("pos") - F.col("_p0"))
    half = period // 2
    w = hw.series_window()
    frame = w.rowsBetween(-half, half)
    if period % 2 == 0:
        ends = F.lag("y", half).over(w) + F.lead("y", half).over(w)
        ma = (F.sum("y").over(frame) - F.lit(0.5) * ends) / F.lit(float(period))
        full = F.count("y").over(frame) == F.lit(period + 1)
    else:
        ma = F.avg("y").over(frame)
        full = F.count("y").over(frame) == F.lit(period)
    d = hw.rolling(d, {"_trend": F.when(full, ma)}, behind=half, ahead=half)
    # linear fits on the first / last `period` trend values
    n_i = F.col("_p1") - F.col("_p0")
    lo_first, hi_last = F.lit(half), n_i - F.lit(half)
    # the back fit uses the `period` trend values before the last one
    back = (F.col("_i") >= hi_last - period) & (F.col("_i") < hi_last)
    fit = d.groupBy("unique_id").agg(
        F.regr_slope(F.when(F.col("_i") < lo_first + period, F.col("_trend")), F.col("_i").cast("double")).alias("_k0"),
        F.regr_intercept(F.when(F.col("_i") < lo_first + period, F.col("_trend")), F.col("_i").cast("double")).alias("_b0"),
        F.regr_slope(F.when(back, F.col("_trend")), F.col("_i").cast("double")).alias("_k1"),
        F.regr_intercept(F.when(back, F.col("_trend")), F.col("_i").cast("double")).alias("_b1"))
    d = d.join(fit, "unique_id")
    trend = F.coalesce(F.col("_trend"),
                       F.when(F.col("_i") < lo_first, F.col("_k0") * F.col("_i") + F.col("_b0"))
                        .otherwise(F.col("_k1") * F.col("_i") + F.col("_b1")))
    d = d.withColumn("trend", trend).withColumn("_det", F.col("y") - F.col("trend")).withColumn("_ph", F.col("_i") % period)
    ph = d.groupBy("unique_id", "_ph").agg(F.avg("_det").alias("_pm"))
    ph = ph.withColumn("seasonal", F.col("_pm") - F.avg("_pm").over(Window.partitionBy("unique_id")))
    d = d.join(ph.select("unique_id", "_ph", "seasonal"), ["unique_id", "_ph"])
    return d.select("unique_id", "ds", "pos", "y", "trend", "seasonal",
                    (F.col("_det") - F.col("seasonal")).alias("resid"))
