"""Calendar, lag and rolling features (X-1..X-4, W-1..W-4, W-6, W-7, W-10, F-18, N-3).

All window columns of one call share one sort: they are computed together in
the bucket + halo layout (see ``windowing``) with the halo set to the largest
look-back, so a long series is spread over many tasks.

``min_periods`` follows pandas: a rolling statistic is NULL unless the frame
holds at least that many non-null values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tspanel.config import FeatureConfig, ShortLagConfig
from tspanel.operators import windowing as hw


# ---------------------------------------------------------------- calendar (X-1..X-4)

def calendar_columns(ds: str = "ds") -> dict[str, Column]:
    """hour, dayofweek (Monday = 0), month, is_weekend, cyclic encodings."""
    hour = F.hour(ds)
    dow = F.weekday(ds)
    two_pi = F.lit(2 * math.pi)
    return {
        "hour": hour,
        "dayofweek": dow,
        "month": F.month(ds),
        "is_weekend": (dow >= 5).cast("int"),
        "hour_sin": F.sin(two_pi * hour / F.lit(24.0)),
        "hour_cos": F.cos(two_pi * hour / F.lit(24.0)),
        "dow_sin": F.sin(two_pi * dow / F.lit(7.0)),
        "dow_cos": F.cos(two_pi * dow / F.lit(7.0)),
    }


def hour_of_week(ds: str = "ds") -> Column:
    """X-3: ``weekday * 24 + hour`` with Monday = 0."""
    return F.weekday(ds) * 24 + F.hour(ds)


def add_calendar(df: DataFrame, ds: str = "ds") -> DataFrame:
    return df.withColumns(calendar_columns(ds))


# ---------------------------------------------------------------- window expressions

def _guard(stat: Column, count: Column, min_periods: int) -> Column:
    return F.when(count >= F.lit(min_periods), stat)


def rolling_exprs(value: str, window: int, min_periods: int, stats: Sequence[str], shifted: bool,
                  prefix: str = "rolling") -> dict[str, Column]:
    """Rolling statistics over the last ``window`` rows; with ``shifted`` the
    current row is excluded (pandas ``shift(1).rolling``)."""
    w = hw.series_window()
    frame = w.rowsBetween(-window, -1) if shifted else w.rowsBetween(-(window - 1), 0)
    y = F.col(value)
    cnt = F.count(y).over(frame)
    fns = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}
    out = {}
    for s in stats:
        if s == "median":
            arr = F.array_sort(F.collect_list(y).over(frame))
            k = F.size(arr)
            mid = F.when(k % 2 == 1, F.element_at(arr, ((k + 1) / 2).cast("int"))).otherwise(
                (F.element_at(arr, (k / 2).cast("int")) + F.element_at(arr, (k / 2 + 1).cast("int"))) / F.lit(2.0))
            out[f"{prefix}_median_{window}"] = _guard(mid, cnt, min_periods)
        else:
            out[f"{prefix}_{s}_{window}"] = _guard(fns[s](y).over(frame), cnt, min_periods)
    return out


def lag_exprs(value: str, lags: Sequence[int], prefix: str = "lag") -> dict[str, Column]:
    w = hw.series_window()
    return {f"{prefix}_{k}": F.lag(F.col(value), k).over(w) for k in lags}


def with_window_columns(df: DataFrame, columns: dict[str, Column], behind: int, ahead: int = 0) -> DataFrame:
    """Evaluate window expressions in the halo layout (needs ``unique_id, pos``)."""
    return hw.rolling(df, columns, behind=behind, ahead=ahead)


# ---------------------------------------------------------------- public operators

def add_lags(df: DataFrame, lags: Sequence[int], value: str = "y") -> DataFrame:
    """W-1."""
    return with_window_columns(df, lag_exprs(value, lags), behind=max(lags))


def add_differences(df: DataFrame, season: int = 24, value: str = "y") -> DataFrame:
    """W-6 / W-7: ``diff_1 = y - lag(y)``, ``diff_<m> = y - lag(y, m)``."""
    w = hw.series_window()
    cols = {"diff_1": F.col(value) - F.lag(value, 1).over(w),
            f"diff_{season}": F.col(value) - F.lag(value, season).over(w)}
    return with_window_columns(df, cols, behind=season)


def add_rolling_means(df: DataFrame, windows: Sequence[int] = (24, 168), value: str = "y") -> DataFrame:
    """W-3: rolling mean of the series itself, ``min_periods = max(2, w // 3)``."""
    cols = {}
    for win in windows:
        cols.update(rolling_exprs(value, win, max(2, win // 3), ["mean"], shifted=False))
    return with_window_columns(df, cols, behind=max(windows))


def add_rolling_median_std(df: DataFrame, window: int = 168, value: str = "y") -> DataFrame:
    """W-4: rolling median and std (n-1), current row included, ``min_periods = w // 2``."""
    cols = rolling_exprs(value, window, window // 2, ["median", "std"], shifted=False)
    return with_window_columns(df, cols, behind=window)


def forecast_features(df: DataFrame, config: FeatureConfig = FeatureConfig(), value: str = "y") -> DataFrame:
    """F-18: 8 calendar + len(lags) lags + 4 per rolling window (shifted,
    ``min_periods = max(2, w // 4)``), in this column order."""
    cols = dict(lag_exprs(value, config.lags))
    for win in config.rolling_windows:
        cols.update(rolling_exprs(value, win, max(2, win // 4), ["mean", "std", "min", "max"], shifted=True))
    behind = max(max(config.lags), max(config.rolling_windows))
    out = with_window_columns(add_calendar(df), cols, behind=behind)
    return out.select(*df.columns, *feature_names(config))


def feature_names(config: FeatureConfig = FeatureConfig()) -> list[str]:
    names = list(calendar_columns().keys()) + [f"lag_{k}" for k in config.lags]
    for win in config.rolling_windows:
        names += [f"rolling_{s}_{win}" for s in ("mean", "std", "min", "max")]
    return names


ISOLATION_FEATURES = ["y", "lag_1", "lag_24", "lag_168", "rolling_mean_24", "rolling_std_24",
                      "rolling_mean_168", "hour", "dayofweek", "month"]


def isolation_features(df: DataFrame, value: str = "y") -> DataFrame:
    """N-3: y, lags 1/24/168, shifted mean/std over 24 (min 12), shifted mean
    over 168 (min 48), hour, weekday, month."""
    w = hw.series_window()
    y = F.col(value)
    f24 = w.rowsBetween(-24, -1)
    f168 = w.rowsBetween(-168, -1)
    cols = {
        "lag_1": F.lag(y, 1).over(w), "lag_24": F.lag(y, 24).over(w), "lag_168": F.lag(y, 168).over(w),
        "rolling_mean_24": _guard(F.avg(y).over(f24), F.count(y).over(f24), 12),
        "rolling_std_24": _guard(F.stddev_samp(y).over(f24), F.count(y).over(f24), 12),
        "rolling_mean_168": _guard(F.avg(y).over(f168), F.count(y).over(f168), 48),
    }
    out = with_window_columns(df, cols, behind=168)
    return out.withColumns({"hour": F.hour("ds"), "dayofweek": F.weekday("ds"), "month": F.month("ds")})


def short_lag_features(df: DataFrame, config: ShortLagConfig = ShortLagConfig(), value: str = "y") -> DataFrame:
    """W-10: lags, shifted rolling mean/std with full windows, day, month,
    weekday, weekend; rows with any missing feature are dropped."""
    cols = dict(lag_exprs(value, config.lags))
    for win in config.rolling_windows:
        cols.update(rolling_exprs(value, win, win, ["mean", "std"], shifted=True))
    behind = max(max(config.lags), max(config.rolling_windows))
    out = with_window_columns(df, cols, behind=behind)
    dow = F.weekday("ds")
    out = out.withColumns({"dayofweek": dow, "month": F.month("ds"), "day": F.dayofmonth("ds"),
                           "is_weekend": (dow >= 5).cast("int")})
    return out.dropna()
