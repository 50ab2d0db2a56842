"""Composite plans (PIPE-1..PIPE-6) built from the operators.

Each returns DataFrames (lazy); nothing is collected except where a tiny
one-row-per-series result feeds driver-side p-value maths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tspanel.config import DAILY_SEASON, HORIZON, PIPELINE_WINDOWS, WEEKLY_SEASON, BacktestConfig
from tspanel.operators import baselines as B
from tspanel.operators import evaluate as E
from tspanel.operators import prepare as P
from tspanel.operators import profile as A

NO_CAP = 10 ** 15

# Extension point: name → fn(panel, cutoffs) returning
# ``unique_id, window, cut, horizon, model, y_pred`` (+ optional band columns).
FORECASTERS: dict = {}


def register_forecaster(name: str, fn) -> None:
    """Add a DataFrame → DataFrame forecaster to every statistical backtest and
    final forecast (it receives the regular panel and the cutoff table)."""
    FORECASTERS[name] = fn


def _with_registered(extra):
    fns = list(FORECASTERS.values()) + ([extra] if extra is not None else [])
    if not fns:
        return None

    def run(panel, cuts):
        out = None
        for fn in fns:
            part = fn(panel, cuts)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out
    return run


from tspanel.session import materialize  # noqa: E402  (re-exported for callers)


def pipeline_backtest(panel: DataFrame, horizon: int = HORIZON, windows: int = PIPELINE_WINDOWS,
                      step_seconds: int = 3600, season: int = DAILY_SEASON,
                      long_season: int = WEEKLY_SEASON, keep: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """F-11: hour-of-week average (F-5) and seasonal naive (F-2) over the
    pipeline windows, scored with the masked metrics and the whole-series
    MASE scale (E-5, E-6). Returns (predictions, metrics by window, leaderboard);
    with ``keep`` the predictions table is materialised once."""
    cuts = B.pipeline_cutoffs(panel, horizon, windows, long_season)
    preds = B.pipeline_forecasts(panel, cuts, step_seconds, horizon, long_season=long_season)
    if keep:
        preds = materialize(preds)
    by_window = E.metrics_by_window(preds, E.full_series_scale(panel, season), form="masked")
    return preds, by_window, E.leaderboard(by_window)


def pipeline_forecast(panel: DataFrame, horizon: int = HORIZON, step_seconds: int = 3600) -> DataFrame:
    """F-12 of the pipeline: hour-of-week average past the end of each series
    (future timestamps by arithmetic from the last timestamp)."""
    fc = B.pipeline_forecasts(panel, B.final_cutoffs(panel), step_seconds, horizon, actuals=False,
                              models=["seasonal_how_average"])
    ds = F.timestamp_seconds(F.unix_seconds("cutoff") + F.col("horizon") * F.lit(step_seconds))
    return fc.select("unique_id", ds.alias("ds"), "horizon", "model", "y_pred")


def prepare_dataset(raw: DataFrame, target: str = "Global_active_power", step_seconds: int = 3600,
                    unique_id: str = "household_1", fill: str = "time") -> dict[str, DataFrame]:
    """PIPE-1: typed raw table → quality blocks, missing table, resampled mean,
    regular grid with gap fill, canonical panel."""
    raw = materialize(raw)          # typed raw table: read by five branches, scanned once
    raw_series = raw.select(F.lit(unique_id).alias("unique_id"), "ds", F.col(target).alias("y"))
    hourly = P.resample(raw_series, step_seconds, "mean", densify=True)
    prepared = P.regularize(hourly.drop("pos"), step_seconds, fill=fill)
    quality = (A.flatten_report(A.quality_report(raw_series), "raw")
               .unionByName(A.flatten_report(A.quality_report(hourly.drop("pos")), "hourly_before_fill"))
               .unionByName(A.flatten_report(A.quality_report(prepared.drop("pos")), "prepared")))
    return {"prepared": prepared, "hourly": hourly, "quality": quality,
            "missing": A.missing_values_table(raw)}


def with_cutoff_ds(df: DataFrame, panel: DataFrame) -> DataFrame:
    """Timestamp of the last training position as ``cutoff``."""
    return df.join(panel.select("unique_id", F.col("pos").alias("cut"), F.col("ds").alias("cutoff")),
                   ["unique_id", "cut"], "left")


def statistical_backtest(panel: DataFrame, cfg: BacktestConfig = BacktestConfig(),
                         models=B.BASELINE_MODELS, long_season: int = WEEKLY_SEASON,
                         extra=None, keep: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """PIPE-3 backtest: F-10 cutoffs → baselines with bands (+ optional fleet
    forecasts from ``extra(panel, cutoffs)``) → P-12 → actuals → clamped
    metrics with the in-sample MASE scale → leaderboard."""
    extra = _with_registered(extra)
    cuts = B.backtest_cutoffs(panel, cfg.horizon, cfg.n_windows, cfg.step, cfg.min_history)
    scales = B.train_scales(panel, cuts, cfg.season, cfg.max_history)
    fc = B.baseline_forecasts(panel, cuts, cfg.horizon, models, cfg.season, long_season, cfg.max_history,
                              scales=scales, actuals=True)
    if extra is not None:
        more = with_cutoff_ds(B.attach_actuals(extra(panel, cuts), panel), panel)
        fc = fc.unionByName(more, allowMissingColumns=True)
    preds = B.valid_forecasts(fc, cfg.horizon).withColumn("group", F.lit("statistical"))
    if keep:
        preds = materialize(preds.join(scales.select("unique_id", "window", "mase_scale"), ["unique_id", "window"], "left"))
        scales = preds.select("unique_id", "window", "mase_scale").distinct()
        preds = preds.drop("mase_scale")
    by_window = E.metrics_by_window(preds, scales.select("unique_id", "window", "mase_scale"), "clamped")
    return preds, by_window, E.leaderboard(by_window)


def statistical_forecast(panel: DataFrame, cfg: BacktestConfig = BacktestConfig(), step_seconds: int = 3600,
                         models=B.BASELINE_MODELS, long_season: int = WEEKLY_SEASON, extra=None) -> DataFrame:
    """F-12: every model fitted on the whole (capped) series, future timestamps."""
    extra = _with_registered(extra)
    cuts = B.final_cutoffs(panel)
    fc = B.baseline_forecasts(panel, cuts, cfg.horizon, models, cfg.season, long_season, cfg.max_history,
                              actuals=True)
    if extra is not None:
        fc = fc.unionByName(with_cutoff_ds(extra(panel, cuts), panel), allowMissingColumns=True)
    fc = B.valid_forecasts(fc, cfg.horizon)
    ds = F.timestamp_seconds(F.unix_seconds("cutoff") + F.col("horizon") * F.lit(step_seconds))
    return fc.withColumn("ds", ds).drop("y", "residual")


def eda_bundle(panel: DataFrame, season: int = DAILY_SEASON) -> dict[str, DataFrame]:
    """PIPE-2: quality, describe, seasonal profiles, rolling means, decomposition,
    ACF / PACF and stationarity tests of a prepared panel."""
    from tspanel.operators import diagnose as D
    from tspanel.operators import features as FT

    acf = D.acf(panel, 72)
    return {
        "quality": A.quality_report(panel.drop("pos")),
        "descriptive_stats": A.describe(panel),
        "profiles": A.seasonal_profiles(panel),
        "rolling_means": FT.add_rolling_means(panel, (season, WEEKLY_SEASON)),
        "decomposition": D.decompose(panel, season),
        "acf": acf,
        "pacf": D.pacf_from_acf(acf),
        "stationarity": D.stationarity_tests(panel),
    }


def anomaly_analysis(panel: DataFrame, config=None) -> dict[str, DataFrame]:
    """PIPE-5: three detectors, combined flags and the summary table."""
    from tspanel.config import AnomalyConfig
    from tspanel.operators import anomaly as N
    from tspanel.operators.isolation import isolation_forest

    cfg = config or AnomalyConfig()
    combined = materialize(N.combine(panel, cfg, isolation=isolation_forest(panel, cfg)))
    return {"anomalies": combined, "summary": N.summary(combined)}


def data_driven_analysis(panel: DataFrame, models=None, step_seconds: int = 3600) -> dict[str, DataFrame]:
    """PIPE-4: ML models (F-19/F-20) and the direct-window model (F-21) over the
    backtest windows, their leaderboards, the combined re-ranked table with its
    selection (J-4) and the final 24-step forecasts of both groups."""
    from tspanel.operators import ml as ML

    cfg = BacktestConfig()
    cuts = B.backtest_cutoffs(panel, cfg.horizon, cfg.n_windows, cfg.step, cfg.min_history)
    scale = E.insample_scale(panel, cuts, cfg.season)
    ml = materialize(with_cutoff_ds(B.attach_actuals(ML.ml_forecasts(panel, cuts, models, step_seconds=step_seconds),
                                                     panel), panel).withColumn("group", F.lit("ML")))
    dl = materialize(with_cutoff_ds(B.attach_actuals(ML.direct_window_forecasts(panel, cuts), panel), panel)
                     .withColumn("group", F.lit("DL")))
    ml_board = E.leaderboard(E.metrics_by_window(ml, scale, "clamped")).withColumn("group", F.lit("ML"))
    dl_board = E.leaderboard(E.metrics_by_window(dl, scale, "clamped")).withColumn("group", F.lit("DL"))
    final = B.final_cutoffs(panel)
    columns = ("unique_id", "ds", "horizon", "model", "y_pred", "group")
    forecasts = B.future_timestamps(ML.ml_forecasts(panel, final, models, step_seconds=step_seconds), panel, step_seconds) \
        .withColumn("group", F.lit("ML")).select(*columns).unionByName(
            B.future_timestamps(ML.direct_window_forecasts(panel, final), panel, step_seconds).withColumn("group", F.lit("DL")).select(*columns))
    combined = E.combine_leaderboards(ml_board, dl_board)
    selections = [E.selection_table(ml_board, group="ML", best_label="primary ML candidate"), E.selection_table(dl_board, group="DL")]
    return {"ml_predictions": ml, "dl_predictions": dl, "ml_leaderboard": ml_board, "dl_leaderboard": dl_board,
            "combined": combined, "selection": E.combine_selection_tables(selections, combined), "forecasts": forecasts}


def statistical_analysis(panel: DataFrame, with_fleet: bool = True, step_seconds: int = 3600) -> dict[str, DataFrame]:
    """PIPE-3: every statistical model backtested, ranked, selected, diagnosed
    and refitted for the final forecast."""
    from tspanel.operators import diagnose as D
    from tspanel.operators import fleet as FL

    extra = (lambda p, c: FL.fleet_forecasts(p, c).drop("error")) if with_fleet else None
    preds, by_window, board = statistical_backtest(panel, extra=extra)
    return {"predictions": preds, "metrics_by_window": by_window, "leaderboard": board,
            "selection": E.selection_table(board),
            "diagnostics": D.residual_diagnostics(preds, E.best_model(board)),
            "forecast": statistical_forecast(panel, step_seconds=step_seconds, extra=extra)}


def run_pipeline(panel: DataFrame, out_dir: str | None = None, boards: list[DataFrame] | None = None,
                 step_seconds: int = 3600, fmt: str = "parquet") -> dict[str, DataFrame]:
    """PIPE-6: validate → rank the available leaderboards → pipeline backtest →
    forecast → statistical tests → table sinks (S-8) under ``out_dir``."""
    from tspanel.operators import diagnose as D
    from tspanel.sources.readers import write_table

    tests = A.validate_series(panel.drop("pos"), step_seconds)
    preds, by_window, board = pipeline_backtest(panel, step_seconds=step_seconds)
    ranked = E.combine_leaderboards(*boards) if boards else board
    out = {"validation": tests, "model_ranking": ranked, "backtest_predictions": preds,
           "backtest_metrics": board, "forecast": pipeline_forecast(panel, step_seconds=step_seconds),
           "statistical_tests": D.pipeline_tests(preds)}
    if out_dir:
        for name, df in out.items():
            write_table(df, f"{out_dir}/{name}", fmt, partition_by=())
    return out
