"""Baseline forecasters, cutoffs and prediction bands (F-1..F-12, X-8, X-9).

Every forecaster is a join / aggregate on grid positions, so all series, all
backtest windows and all horizon steps are computed by one plan. Input is a
regular panel (``unique_id, ds, y, pos``) and a cutoff table
``unique_id, window, cut`` where ``cut`` is the last training position; the
training part of a window is positions ``lo..cut`` with
``lo = max(1, cut - max_history + 1)`` (F-9).

Output of every forecaster: ``unique_id, window, cut, horizon, model, y_pred``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tspanel.config import (DAILY_SEASON, HORIZON, LEVEL_MULTIPLIERS, RECENT_WEEKS, SCALE_FALLBACK, WEEKLY_SEASON)
from tspanel.operators import windowing as hw
from tspanel.operators.prepare import series_length
from tspanel.operators.ranges import pop_std, range_sums

KEYS = ["unique_id", "window", "cut"]

BASELINE_MODELS = ("naive", "seasonal_naive_24", "seasonal_naive_168", "window_average_168",
                   "seasonal_window_average", "drift")


# ---------------------------------------------------------------- cutoffs (F-10, F-11, F-12)

def backtest_cutoffs(panel: DataFrame, horizon: int = HORIZON, n_windows: int = 3, step: int = 24,
                     min_history: int = DAILY_SEASON * 14) -> DataFrame:
    """F-10: ``cut = n - h - (W-1)*step + (w-1)*step`` for w = 1..W.

    Series shorter than ``h + (W-1)*step + max(min_history, h)`` get no
    windows (the reference raises for its single series).
    """
    need = horizon + (n_windows - 1) * step + max(min_history, horizon)
    return (series_length(panel).filter(F.col("n") >= F.lit(need))
            .withColumn("window", F.explode(F.sequence(F.lit(1), F.lit(n_windows))))
            .withColumn("cut", (F.col("n") - F.lit(horizon + (n_windows - 1) * step)
                                + (F.col("window") - 1) * F.lit(step)).cast("long"))
            .select("unique_id", "window", "cut", "n"))


def pipeline_cutoffs(panel: DataFrame, horizon: int = HORIZON, n_windows: int = 5,
                     long_season: int = WEEKLY_SEASON) -> DataFrame:
    """F-11: windows shrink to ``max(1, min(W, (n-168)//h - 1))`` for short series;
    window j (oldest first) trains on positions ``1..n - (W'-j+1)*h``."""
    n = F.col("n")
    short = n < F.lit(long_season + horizon * (n_windows + 1))
    shrunk = F.greatest(F.lit(1), F.least(F.lit(n_windows), F.floor((n - F.lit(long_season)) / F.lit(horizon)) - 1))
    wcount = F.when(short, shrunk).otherwise(F.lit(n_windows)).cast("int")
    return (series_length(panel).withColumn("_w", wcount)
            .withColumn("window", F.explode(F.sequence(F.lit(1), F.col("_w"))))
            .withColumn("cut", (n - (F.col("_w") - F.col("window") + 1) * F.lit(horizon)).cast("long"))
            .filter(F.col("cut") >= 1)
            .select("unique_id", "window", "cut", "n"))


def final_cutoffs(panel: DataFrame) -> DataFrame:
    """F-12: one pseudo-window 0 whose training part is the whole series."""
    return series_length(panel).select("unique_id", F.lit(0).alias("window"), F.col("n").alias("cut"), "n")


# ---------------------------------------------------------------- helpers

def _train_lo(max_history: int | None) -> Column:
    """First training position: 1, or that of the last ``max_history`` rows if the caller asks for so many."""
    if max_history is None:
        return F.lit(1).cast("long")
    return F.greatest(F.lit(1), F.col("cut") - F.lit(max_history - 1))


def _steps(cutoffs: DataFrame, horizon: int) -> DataFrame:
    """(series, window) × horizon steps 1..h (X-9 index)."""
    return cutoffs.select(*KEYS, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))


def _values(panel: DataFrame, pos_name: str, val_name: str) -> DataFrame:
    return panel.select("unique_id", F.col("pos").alias(pos_name), F.col("y").alias(val_name))


def lookup(requests: DataFrame, panel: DataFrame, pos_col: str, val_name: str) -> DataFrame:
    """Attach ``y`` at position ``pos_col``: an equi-join on (unique_id, pos),
    which spreads a long series over many partitions."""
    return requests.join(_values(panel, pos_col, val_name), ["unique_id", pos_col], "left")


def _last_value(panel: DataFrame, cutoffs: DataFrame) -> DataFrame:
    req = cutoffs.select(*KEYS, F.col("cut").alias("_lp"))
    return lookup(req, panel, "_lp", "last_y").drop("_lp")


# ---------------------------------------------------------------- forecasters

def naive(panel: DataFrame, cutoffs: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """F-1: last training value for every step."""
    last = _last_value(panel, cutoffs)
    return (_steps(cutoffs, horizon).join(last, KEYS)
            .select(*KEYS, "horizon", F.lit("naive").alias("model"), F.col("last_y").alias("y_pred")))


def seasonal_naive(panel: DataFrame, cutoffs: DataFrame, season: int, horizon: int = HORIZON,
                   max_history: int | None = None, name: str | None = None) -> DataFrame:
    """F-2: ``y[cut - m + 1 + ((i-1) % m)]``; training part shorter than m →
    last value."""
    name = name or f"seasonal_naive_{season}"
    length = F.col("cut") - _train_lo(max_history) + 1
    src = F.when(length < F.lit(season), F.col("cut")).otherwise(
        F.col("cut") - F.lit(season - 1) + (F.col("horizon") - 1) % F.lit(season))
    req = _steps(cutoffs, horizon).withColumn("_sp", src)
    return lookup(req, panel, "_sp", "y_pred").select(*KEYS, "horizon", F.lit(name).alias("model"), "y_pred")


def window_average(panel: DataFrame, cutoffs: DataFrame, window: int = WEEKLY_SEASON,
                   horizon: int = HORIZON, max_history: int | None = None) -> DataFrame:
    """F-3: mean of the last ``window`` training values, constant over steps."""
    lo = F.greatest(_train_lo(max_history), F.col("cut") - F.lit(window - 1))
    req = cutoffs.select(*KEYS, F.explode(F.sequence(lo, F.col("cut"))).alias("_sp"))
    avg = lookup(req, panel, "_sp", "_v").groupBy(*KEYS).agg(F.avg("_v").alias("y_pred"))
    return (_steps(cutoffs, horizon).join(avg, KEYS)
            .select(*KEYS, "horizon", F.lit(f"window_average_{window}").alias("model"), "y_pred"))


def seasonal_window_average(panel: DataFrame, cutoffs: DataFrame, season: int = DAILY_SEASON,
                            n_seasons: int = 7, horizon: int = HORIZON,
                            max_history: int | None = None) -> DataFrame:
    """F-4 (daily form): mean over k < n_seasons of
    ``y[cut - m + 1 + ((i-1) % m) - k*m]`` for positions inside the training
    part; none inside → last value."""
    lo = _train_lo(max_history)
    base = F.col("cut") - F.lit(season - 1) + (F.col("horizon") - 1) % F.lit(season)
    req = (_steps(cutoffs, horizon)
           .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n_seasons - 1))))
           .withColumn("_sp", base - F.col("_k") * F.lit(season))
           .withColumn("_sp", F.when((F.col("_sp") >= lo) & (F.col("_sp") <= F.col("cut")), F.col("_sp"))))
    avg = (lookup(req, panel, "_sp", "_v").groupBy(*KEYS, "horizon")
           .agg(F.avg(F.when(F.col("_sp").isNotNull(), F.col("_v"))).alias("_m"),
                F.count("_sp").alias("_c")))
    last = _last_value(panel, cutoffs)
    return (avg.join(last, KEYS)
            .select(*KEYS, "horizon", F.lit("seasonal_window_average").alias("model"),
                    F.when(F.col("_c") > 0, F.col("_m")).otherwise(F.col("last_y")).alias("y_pred")))


def drift(panel: DataFrame, cutoffs: DataFrame, horizon: int = HORIZON,
          max_history: int | None = None) -> DataFrame:
    """F-6: ``y[cut] + i * (y[cut] - y[lo]) / (len - 1)``; slope 0 when len = 1."""
    req = cutoffs.select(*KEYS, _train_lo(max_history).alias("_fp"), F.col("cut").alias("_lp"))
    ends = lookup(lookup(req, panel, "_fp", "_first"), panel, "_lp", "_last")
    length = F.col("cut") - F.col("_fp") + 1
    slope = F.when(length > 1, (F.col("_last") - F.col("_first")) / (length - 1)).otherwise(F.lit(0.0))
    return (_steps(cutoffs, horizon).join(ends.withColumn("_slope", slope).select(*KEYS, "_last", "_slope"), KEYS)
            .select(*KEYS, "horizon", F.lit("drift").alias("model"),
                    (F.col("_last") + F.col("_slope") * F.col("horizon")).alias("y_pred")))


def seasonal_how_average(panel: DataFrame, cutoffs: DataFrame, step_seconds: int = 3600,
                         horizon: int = HORIZON, recent_weeks: int = RECENT_WEEKS,
                         fallback_window: int = DAILY_SEASON) -> DataFrame:
    """F-5 (hour-of-week form): mean of the last ``recent_weeks`` training values
    with the same weekday and hour as the target slot; fallback mean of the
    last ``fallback_window`` values; then the last value.

    On a regular grid whose step divides a week and is a multiple of one hour,
    the matching rows are exactly positions ``target - k * period``.
    """
    week = 7 * 24 * 3600
    if week % step_seconds or step_seconds % 3600:
        raise ValueError("seasonal_how_average needs a step that is a whole number of hours dividing a week")
    period = week // step_seconds
    target = F.col("cut") + F.col("horizon")
    req = (_steps(cutoffs, horizon)
           .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(recent_weeks))))
           .withColumn("_sp", target - F.col("_k") * F.lit(period))
           .filter(F.col("_sp") >= 1))
    how = lookup(req, panel, "_sp", "_v").groupBy(*KEYS, "horizon").agg(F.avg("_v").alias("_how"))
    lo = F.greatest(F.lit(1), F.col("cut") - F.lit(fallback_window - 1))
    fb_req = cutoffs.select(*KEYS, F.explode(F.sequence(lo, F.col("cut"))).alias("_sp"))
    fb = lookup(fb_req, panel, "_sp", "_v").groupBy(*KEYS).agg(F.avg("_v").alias("_fb"))
    last = _last_value(panel, cutoffs)
    return (_steps(cutoffs, horizon).join(how, KEYS + ["horizon"], "left").join(fb, KEYS, "left").join(last, KEYS)
            .select(*KEYS, "horizon", F.lit("seasonal_how_average").alias("model"),
                    F.coalesce("_how", "_fb", "last_y").alias("y_pred")))


# ---------------------------------------------------------------- residual scale and bands (F-7, F-8)

def train_scales(panel: DataFrame, cutoffs: DataFrame, season: int = DAILY_SEASON,
                 max_history: int | None = None) -> DataFrame:
    """Both per-window training statistics in one pass over the series:

    * ``scale`` (F-7): population std of ``y[t] - y[t-m]`` over the (capped)
      training part; part of length ``<= m`` → std of first differences;
      one value → 0.1 (raw, before the F-8 fallback);
    * ``mase_scale`` (E-4): mean ``|y[t] - y[t-m]|`` over the whole training
      history ``1..cut`` (``<= m`` values → lag 1), floored at 1e-8.

    One halo window yields both differences; one segment aggregation serves
    the four range families. Returns ``unique_id, window, cut, scale, mase_scale``.
    """
    from tspanel.config import EPS

    w = hw.series_window()
    diffs = hw.rolling(panel.select("unique_id", "pos", "y"),
                       {"_dm": F.col("y") - F.lag("y", season).over(w),
                        "_d1": F.col("y") - F.lag("y", 1).over(w)}, behind=season)
    lo = _train_lo(max_history)
    base = cutoffs.select(*KEYS, lo.alias("_lo"))
    fams = {"seas": (F.col("_lo") + season, F.col("cut")), "first": (F.col("_lo") + 1, F.col("cut")),
            "mseas": (F.lit(1 + season), F.col("cut")), "mfirst": (F.lit(2), F.col("cut"))}
    ranges = None
    for name, (a, b) in fams.items():
        part = base.select(*KEYS, F.lit(name).alias("fam"), a.cast("long").alias("lo"), b.cast("long").alias("hi"))
        ranges = part if ranges is None else ranges.unionByName(part)
    sums = range_sums(diffs.select("unique_id", "pos", "_dm", "_d1"), ranges, ["_dm", "_d1"], keys=("window", "cut", "fam"))

    def pick(fam: str, expr) -> Column:
        return F.max(F.when(F.col("fam") == fam, expr))

    std_m = pop_std("n__dm", "s__dm", "ss__dm")
    std_1 = pop_std("n__d1", "s__d1", "ss__d1")
    wide = sums.groupBy(*KEYS).agg(pick("seas", std_m).alias("_sm"), pick("first", std_1).alias("_s1"),
                                   pick("mseas", F.try_divide(F.col("sa__dm"), F.col("n__dm"))).alias("_mm"),
                                   pick("mfirst", F.try_divide(F.col("sa__d1"), F.col("n__d1"))).alias("_m1"))
    out = base.join(wide, KEYS, "left")
    length = F.col("cut") - F.col("_lo") + 1
    scale = (F.when(length > season, F.col("_sm")).when(length > 1, F.col("_s1")).otherwise(F.lit(SCALE_FALLBACK)))
    mase = F.greatest(F.when(F.col("cut") > season, F.col("_mm")).otherwise(F.col("_m1")), F.lit(EPS))
    return out.select(*KEYS, scale.alias("scale"), mase.alias("mase_scale"))


def residual_scale(panel: DataFrame, cutoffs: DataFrame, season: int = DAILY_SEASON,
                   max_history: int | None = None) -> DataFrame:
    """F-7 alone: ``unique_id, window, cut, scale``."""
    return train_scales(panel, cutoffs, season, max_history).drop("mase_scale")


def with_bands(forecasts: DataFrame, scales: DataFrame) -> DataFrame:
    """F-8: ``y_pred ± 1.28·scale`` and ``± 1.96·scale``; scale not finite or
    ``<= 0`` → 0.1."""
    s = F.col("scale")
    s = F.when(s.isNotNull() & ~F.isnan(s) & (s > 0) & (F.abs(s) != F.lit(float("inf"))), s).otherwise(F.lit(SCALE_FALLBACK))
    out = forecasts.join(scales, KEYS, "left").withColumn("scale", s)
    for level, mult in LEVEL_MULTIPLIERS.items():
        out = out.withColumn(f"lower_{level}", F.col("y_pred") - F.lit(mult) * F.col("scale"))
        out = out.withColumn(f"upper_{level}", F.col("y_pred") + F.lit(mult) * F.col("scale"))
    return out.drop("scale")


def with_band_columns(forecasts: DataFrame) -> DataFrame:
    """F-8 on rows that already carry the raw ``scale`` column."""
    s = F.col("scale")
    s = F.when(s.isNotNull() & ~F.isnan(s) & (s > 0) & (F.abs(s) != F.lit(float("inf"))), s).otherwise(F.lit(SCALE_FALLBACK))
    out = forecasts.withColumn("scale", s)
    for level, mult in LEVEL_MULTIPLIERS.items():
        out = out.withColumn(f"lower_{level}", F.col("y_pred") - F.lit(mult) * F.col("scale"))
        out = out.withColumn(f"upper_{level}", F.col("y_pred") + F.lit(mult) * F.col("scale"))
    return out.drop("scale")


def no_bands(forecasts: DataFrame) -> DataFrame:
    out = forecasts
    for level in LEVEL_MULTIPLIERS:
        out = out.withColumn(f"lower_{level}", F.lit(None).cast("double"))
        out = out.withColumn(f"upper_{level}", F.lit(None).cast("double"))
    return out


def valid_forecasts(forecasts: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """P-12: keep a (series, window, model) only when it has ``horizon`` finite
    predictions."""
    p = F.col("y_pred")
    bad = p.isNull() | F.isnan(p) | (F.abs(p) == F.lit(float("inf")))
    ok = (forecasts.groupBy(*KEYS, "model")
          .agg(F.count(F.lit(1)).alias("_n"), F.count_if(bad).alias("_bad"))
          .filter((F.col("_n") == horizon) & (F.col("_bad") == 0)).drop("_n", "_bad"))
    return forecasts.join(ok, KEYS + ["model"], "left_semi")


# ---------------------------------------------------------------- bundles

def _requests(cutoffs: DataFrame, horizon: int, models: Sequence[str], season: int, long_season: int,
              max_history: int) -> DataFrame:
    """Every position any selected baseline reads, as one table
    ``KEYS, model, horizon, _sp`` (horizon 0 = per-window constants)."""
    lo = _train_lo(max_history)
    length = F.col("cut") - lo + 1
    step = F.col("horizon")
    parts = [cutoffs.select(*KEYS, F.lit("_last").alias("model"), F.lit(0).alias("horizon"), F.col("cut").alias("_sp"))]
    steps = _steps(cutoffs, horizon)
    for m in (season, long_season):
        if f"seasonal_naive_{m}" in models:
            src = F.when(length < F.lit(m), F.col("cut")).otherwise(F.col("cut") - F.lit(m - 1) + (step - 1) % F.lit(m))
            parts.append(steps.select(*KEYS, F.lit(f"seasonal_naive_{m}").alias("model"), "horizon", src.alias("_sp")))
    if f"window_average_{long_season}" in models:
        wlo = F.greatest(lo, F.col("cut") - F.lit(long_season - 1))
        parts.append(cutoffs.select(*KEYS, F.lit("_wavg").alias("model"), F.lit(0).alias("horizon"),
                                    F.explode(F.sequence(wlo, F.col("cut"))).alias("_sp")))
    if "seasonal_window_average" in models:
        base = F.col("cut") - F.lit(season - 1) + (step - 1) % F.lit(season)
        ks = F.filter(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda k: base - k * F.lit(season)),
                      lambda p: (p >= lo) & (p <= F.col("cut")))
        parts.append(steps.select(*KEYS, F.lit("seasonal_window_average").alias("model"), "horizon",
                                  F.explode_outer(ks).alias("_sp")))
    if "drift" in models:
        parts.append(cutoffs.select(*KEYS, F.lit("_first").alias("model"), F.lit(0).alias("horizon"), lo.alias("_sp")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _lookup_agg(panel: DataFrame, req: DataFrame) -> DataFrame:
    """Join every requested position to the panel once and aggregate per
    (window, model, step): mean value, number of requested positions, and the
    timestamp (for single-position requests)."""
    vals = panel.select("unique_id", F.col("pos").alias("_sp"), F.col("y").alias("_v"), F.col("ds").alias("_d"))
    return (req.join(vals, ["unique_id", "_sp"], "left")
               .groupBy(*KEYS, "model", "horizon")
               .agg(F.avg("_v").alias("_m"), F.count("_sp").alias("_c"), F.max("_d").alias("_ds")))


def _pick(name: str, col: str = "_m") -> Column:
    return F.max(F.when(F.col("model") == name, F.col(col)))


def _assemble(agg: DataFrame, step_names: Sequence[str], const_names: Sequence[str],
              models: list[tuple[str, Column]], scales: DataFrame | None) -> DataFrame:
    """Wide per-step rows (+ per-window constants, + scales) → one long row per
    model: ``KEYS, horizon, model, y_pred, y, ds, cutoff[, scale]``."""
    step = agg.filter(F.col("horizon") > 0).groupBy(*KEYS, "horizon").agg(
        _pick("_actual").alias("y"), _pick("_actual", "_ds").alias("ds"),
        *[_pick(n).alias(f"m_{n}") for n in step_names], *[_pick(n, "_c").alias(f"c_{n}") for n in step_names])
    const = agg.filter(F.col("horizon") == 0).groupBy(*KEYS).agg(
        _pick("_last", "_ds").alias("cutoff"), *[_pick(n).alias(n) for n in const_names])
    if scales is not None:
        const = const.join(scales.select(*KEYS, "scale"), KEYS, "left")
    wide = step.join(const, KEYS)
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), expr.alias("y_pred")) for name, expr in models]))
    keep = ["scale"] if scales is not None else []
    return (wide.select(*KEYS, "horizon", "y", "ds", "cutoff", *keep, rows.alias("_r"))
                .select(*KEYS, "horizon", F.col("_r.model").alias("model"), F.col("_r.y_pred").alias("y_pred"),
                        "y", "ds", "cutoff", *keep))


def baseline_forecasts(panel: DataFrame, cutoffs: DataFrame, horizon: int = HORIZON,
                       models: Sequence[str] = BASELINE_MODELS, season: int = DAILY_SEASON,
                       long_season: int = WEEKLY_SEASON, max_history: int | None = None,
                       bands: bool = True, scales: DataFrame | None = None, actuals: bool = False) -> DataFrame:
    """F-1..F-8 for every (series, window): long table with bands.

    All forecasters share ONE lookup: the positions they read (and, with
    ``actuals``, the target positions) form one request table, joined once to
    the panel on (unique_id, pos) and aggregated once, so the panel is shuffled
    once whatever the number of models. With ``actuals`` the rows also carry
    ``y``, ``ds``, ``residual`` and ``cutoff`` (J-1).
    """
    req = _requests(cutoffs, horizon, models, season, long_season, max_history)
    req = req.unionByName(_steps(cutoffs, horizon).select(*KEYS, F.lit("_actual").alias("model"), "horizon",
                                                          (F.col("cut") + F.col("horizon")).alias("_sp")))
    agg = _lookup_agg(panel, req)
    step_names = [m for m in models if m.startswith("seasonal_naive_") or m == "seasonal_window_average"]
    lo = _train_lo(max_history)
    length = F.col("cut") - lo + 1
    slope = F.when(length > 1, F.try_divide(F.col("_last") - F.col("_first"), length - 1)).otherwise(F.lit(0.0))
    exprs = {
        "naive": F.col("_last"),
        f"window_average_{long_season}": F.col("_wavg"),
        "drift": F.col("_last") + slope * F.col("horizon"),
        "seasonal_window_average": F.when(F.col("c_seasonal_window_average") == 0, F.col("_last"))
                                    .otherwise(F.col("m_seasonal_window_average")),
    }
    chosen = [(m, exprs.get(m, F.col(f"m_{m}"))) for m in models]
    if bands and scales is None:
        scales = residual_scale(panel, cutoffs, season, max_history)
    out = _assemble(agg, step_names, ["_last", "_first", "_wavg"], chosen, scales if bands else None)
    out = with_band_columns(out) if bands else no_bands(out)
    if actuals:
        return out.withColumn("residual", F.col("y") - F.col("y_pred"))
    return out.select(*KEYS, "horizon", "model", "y_pred", *[f"{s}_{lv}" for lv in LEVEL_MULTIPLIERS
                                                               for s in ("lower", "upper")])


def pipeline_forecasts(panel: DataFrame, cutoffs: DataFrame, step_seconds: int = 3600, horizon: int = HORIZON,
                       recent_weeks: int = RECENT_WEEKS, fallback_window: int = DAILY_SEASON,
                       long_season: int = WEEKLY_SEASON, actuals: bool = True,
                       models: Sequence[str] | None = None) -> DataFrame:
    """F-5 (hour-of-week average) and F-2 (seasonal naive, whole history) of
    the final pipeline through one request table; with ``actuals`` the rows
    carry ``y``, ``ds``, ``residual``, ``cutoff``. ``models`` restricts the
    requests to the models asked for."""
    models = list(models or ("seasonal_how_average", f"seasonal_naive_{long_season}"))
    week = 7 * 24 * 3600
    if week % step_seconds or step_seconds % 3600:
        raise ValueError("seasonal_how_average needs a step that is a whole number of hours dividing a week")
    period = week // step_seconds
    steps = _steps(cutoffs, horizon)
    target = F.col("cut") + F.col("horizon")
    how = F.filter(F.transform(F.sequence(F.lit(1), F.lit(recent_weeks)), lambda k: target - k * F.lit(period)),
                   lambda p: p >= 1)
    sn = F.when(F.col("cut") < F.lit(long_season), F.col("cut")).otherwise(
        F.col("cut") - F.lit(long_season - 1) + (F.col("horizon") - 1) % F.lit(long_season))
    fb_lo = F.greatest(F.lit(1), F.col("cut") - F.lit(fallback_window - 1))
    parts = [cutoffs.select(*KEYS, F.lit("_last").alias("model"), F.lit(0).alias("horizon"), F.col("cut").alias("_sp"))]
    if "seasonal_how_average" in models:
        parts.append(steps.select(*KEYS, F.lit("seasonal_how_average").alias("model"), "horizon",
                                  F.explode_outer(how).alias("_sp")))
        parts.append(cutoffs.select(*KEYS, F.lit("_fb").alias("model"), F.lit(0).alias("horizon"),
                                    F.explode(F.sequence(fb_lo, F.col("cut"))).alias("_sp")))
    if f"seasonal_naive_{long_season}" in models:
        parts.append(steps.select(*KEYS, F.lit(f"seasonal_naive_{long_season}").alias("model"), "horizon", sn.alias("_sp")))
    if actuals or len(parts) == 1:
        parts.append(steps.select(*KEYS, F.lit("_actual").alias("model"), "horizon", target.alias("_sp")))
    req = parts[0]
    for p in parts[1:]:
        req = req.unionByName(p)
    agg = _lookup_agg(panel, req)
    exprs = {"seasonal_how_average": F.coalesce(F.col("m_seasonal_how_average"), F.col("_fb"), F.col("_last")),
             f"seasonal_naive_{long_season}": F.col(f"m_seasonal_naive_{long_season}")}
    out = _assemble(agg, models, ["_last", "_fb"], [(m, exprs[m]) for m in models], None)
    if actuals:
        return out.withColumn("residual", F.col("y") - F.col("y_pred"))
    return out.select(*KEYS, "horizon", "model", "y_pred", "cutoff")


def attach_actuals(forecasts: DataFrame, panel: DataFrame) -> DataFrame:
    """J-1: target timestamp and actual ``y`` of every forecast step (left join,
    future steps beyond the series keep NULL ``y``), plus residual."""
    tgt = forecasts.withColumn("_tp", F.col("cut") + F.col("horizon"))
    vals = panel.select("unique_id", F.col("pos").alias("_tp"), F.col("y"), F.col("ds"))
    out = tgt.join(vals, ["unique_id", "_tp"], "left").drop("_tp")
    return out.withColumn("residual", F.col("y") - F.col("y_pred"))


def future_timestamps(forecasts: DataFrame, panel: DataFrame, step_seconds: int = 3600) -> DataFrame:
    """X-9: ``ds = ds[cut] + horizon * step`` for forecasts past the end."""
    last = panel.select("unique_id", F.col("pos").alias("cut"), F.col("ds").alias("_cut_ds"))
    out = forecasts.join(last, ["unique_id", "cut"], "left")
    return out.withColumn("ds", F.timestamp_seconds(F.unix_seconds("_cut_ds") + F.col("horizon") * F.lit(step_seconds))).drop("_cut_ds")
