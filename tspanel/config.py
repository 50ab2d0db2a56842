"""Option dataclasses.

Fixed values that must equal the reference semantics (kept together here):
  horizon 24 steps; daily season 24; weekly season 168; seed 42;
  backtest windows 3 with step 24; final pipeline windows 5;
  statistical history cap 35,040 rows; ML history cap 17,520 rows;
  direct-window input 168, train rows 8,760;
  interval levels 80 and 95 with multipliers 1.28 and 1.96;
  residual-scale fallback 0.1; metric epsilon 1e-8;
  anomaly: rolling window 168, z threshold 3.5, IQR multiplier 3.0,
  isolation contamination 0.01, 200 trees, sub-sample 256;
  ML lags 1, 2, 3, 6, 12, 24, 48, 72, 168; ML rolling windows 24, 168;
  short lag preset lags 1, 2, 3, 7, 14 and rolling windows 7, 14, 30;
  Holt-Winters / Theta history 1,440 rows; ARIMA history 720 rows;
  hour-of-week average: 8 recent weeks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

HORIZON = 24
DAILY_SEASON = 24
WEEKLY_SEASON = 168
SEED = 42
BACKTEST_WINDOWS = 3
BACKTEST_STEP = 24
PIPELINE_WINDOWS = 5
MAX_TRAIN_HISTORY = 24 * 365 * 4
ML_MAX_TRAIN = 24 * 365 * 2
DIRECT_INPUT = 168
DIRECT_TRAIN = 24 * 365
LEVEL_MULTIPLIERS = {80: 1.28, 95: 1.96}
SCALE_FALLBACK = 0.1
EPS = 1e-8
RECENT_WEEKS = 8

# Default bucket length (in grid steps) for the bucket + halo window layout.
BUCKET_STEPS = 8192


@dataclass(frozen=True)
class AnomalyConfig:
    rolling_window: int = 168
    rolling_z_threshold: float = 3.5
    iqr_multiplier: float = 3.0
    isolation_contamination: float = 0.01
    n_trees: int = 200
    sample_size: int = 256
    seed: int = SEED


@dataclass(frozen=True)
class FeatureConfig:
    lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24, 48, 72, 168)
    rolling_windows: tuple[int, ...] = (24, 168)
    max_train_size: int | None = None      # whole history; a number keeps the last rows


@dataclass(frozen=True)
class BacktestConfig:
    horizon: int = HORIZON
    n_windows: int = BACKTEST_WINDOWS
    step: int = BACKTEST_STEP
    max_history: int | None = None         # whole history; a number keeps the last rows
    season: int = DAILY_SEASON
    min_history: int = DAILY_SEASON * 14


@dataclass(frozen=True)
class ShortLagConfig:
    lags: tuple[int, ...] = (1, 2, 3, 7, 14)
    rolling_windows: tuple[int, ...] = (7, 14, 30)


@dataclass(frozen=True)
class SeriesSpec:
    """How a panel is laid out: step length in seconds and season lengths."""

    step_seconds: int = 3600
    season: int = DAILY_SEASON
    long_season: int = WEEKLY_SEASON
    extra: dict = field(default_factory=dict)
