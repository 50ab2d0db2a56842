"""Scoring, ranking and selection (E-4..E-10, A-11, W-9, T-2, T-3, U-1, M-1, M-2, P-10, P-11).

Leaderboards are per series: metrics by (series, model, window), then the mean
over windows, ranked by sMAPE with the model name as tiebreak.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tspanel.config import DAILY_SEASON, EPS
from tspanel.functions import metrics as M
from tspanel.operators import windowing as hw
from tspanel.operators.ranges import range_moments
from tspanel.schema import METRIC_COLUMNS

KEYS = ["unique_id", "window", "cut"]


def _abs_diffs(panel: DataFrame, season: int) -> DataFrame:
    w = hw.series_window()
    return hw.rolling(panel.select("unique_id", "pos", "y"),
                      {"_ads": F.abs(F.col("y") - F.lag("y", season).over(w)),
                       "_ad1": F.abs(F.col("y") - F.lag("y", 1).over(w))}, behind=season)


def insample_scale(panel: DataFrame, cutoffs: DataFrame, season: int = DAILY_SEASON,
                   history: int | None = None) -> DataFrame:
    """E-4 scale per (series, window): mean ``|y[t] - y[t-m]|`` over the in-sample
    part ``lo..cut`` (``lo = 1``, or the last ``history`` rows); part of length
    ``<= m`` uses lag 1; floored at 1e-8. Returns ``unique_id, window, cut, mase_scale``."""
    diffs = _abs_diffs(panel, season)
    lo = F.lit(1) if history is None else F.greatest(F.lit(1), F.col("cut") - F.lit(history - 1))
    rng = cutoffs.select(*KEYS, lo.alias("_lo"), (F.col("cut") - lo + 1).alias("_len"))
    seas = range_moments(diffs.select("unique_id", "pos", F.col("_ads").alias("v")),
                         rng.select(*KEYS, (F.col("_lo") + season).alias("lo"), F.col("cut").alias("hi")),
                         keys=("window", "cut"))
    one = range_moments(diffs.select("unique_id", "pos", F.col("_ad1").alias("v")),
                        rng.select(*KEYS, (F.col("_lo") + 1).alias("lo"), F.col("cut").alias("hi")),
                        keys=("window", "cut"))
    out = (rng.join(seas.select(*KEYS, F.try_divide(F.col("sa"), F.col("cnt")).alias("_ms")), KEYS, "left")
              .join(one.select(*KEYS, F.try_divide(F.col("sa"), F.col("cnt")).alias("_m1")), KEYS, "left"))
    raw = F.when(F.col("_len") > season, F.col("_ms")).otherwise(F.col("_m1"))
    return out.select(*KEYS, F.greatest(raw, F.lit(EPS)).alias("mase_scale"))


def full_series_scale(panel: DataFrame, season: int = DAILY_SEASON) -> DataFrame:
    """E-6: mean ``|y[t] - y[t-m]|`` over the whole series (test rows included);
    not finite or ``<= 0`` → 1.0. Returns ``unique_id, mase_scale``."""
    diffs = _abs_diffs(panel, season)
    agg = diffs.groupBy("unique_id").agg(F.avg("_ads").alias("_m"))
    m = F.col("_m")
    ok = m.isNotNull() & ~F.isnan(m) & (m > 0) & (m != F.lit(float("inf")))
    return agg.select("unique_id", F.when(ok, m).otherwise(F.lit(1.0)).alias("mase_scale"))


def metrics_by_window(predictions: DataFrame, scales: DataFrame | None = None, form: str = "clamped",
                      by: Sequence[str] = ("unique_id", "model", "window")) -> DataFrame:
    """E-7 (first level): metrics per (series, model, window).

    ``form="clamped"``: E-1..E-4 (mase = mae / scale);
    ``form="masked"``: E-1, E-5, E-6 (mase = mae / scale when scale > 0).
    ``scales`` is keyed by (unique_id, window) or by unique_id alone.
    """
    aggs = M.clamped_metrics() if form == "clamped" else M.masked_metrics()
    out = predictions.groupBy(*by).agg(*aggs)
    if scales is None:
        return out.withColumn("mase", F.lit(None).cast("double"))
    keys = [k for k in ("unique_id", "window") if k in scales.columns]
    out = out.join(scales.select(*keys, "mase_scale"), keys, "left")
    mase = F.try_divide(F.col("mae"), F.col("mase_scale"))
    if form == "masked":
        mase = F.when(F.col("mase_scale") > 0, mase)
    return out.withColumn("mase", mase).drop("mase_scale")


def rank_models(table: DataFrame, partition: Sequence[str] = ("unique_id",), metric: str = "smape") -> DataFrame:
    """W-9: 1..n by metric, model name as tiebreak (no ties)."""
    w = Window.partitionBy(*partition).orderBy(F.col(metric).asc_nulls_last(), F.col("model"))
    return table.withColumn("rank", F.row_number().over(w))


def leaderboard(by_window: DataFrame, by: Sequence[str] = ("unique_id",)) -> DataFrame:
    """E-7 / A-11: mean over windows per (series, model), ranked by sMAPE."""
    extra = [c for c in ("group",) if c in by_window.columns]
    summary = by_window.groupBy(*by, "model", *extra).agg(*[F.avg(c).alias(c) for c in METRIC_COLUMNS])
    return rank_models(summary, by).select(*by, "rank", "model", *extra, *METRIC_COLUMNS)


def best_model(board: DataFrame, by: Sequence[str] = ("unique_id",)) -> DataFrame:
    """T-3: first row of each leaderboard."""
    return board.filter(F.col("rank") == 1).select(*by, "model")


def top_k(board: DataFrame, k: int, by: Sequence[str] = ("unique_id",)) -> DataFrame:
    """T-2: the k best rows of every leaderboard."""
    return board.filter(F.col("rank") <= k)


# ---------------------------------------------------------------- selection tables (E-8, P-9, P-10)

# Model → group of the statistical selection table.
STATISTICAL_GROUPS = {
    "naive": "baseline",
    "seasonal_naive_24": "baseline",
    "seasonal_naive_168": "baseline",
    "window_average_168": "statistical",
    "seasonal_window_average": "statistical",
    "drift": "statistical",
    "manual_ets_additive": "statistical_manual",
    "manual_theta_24": "statistical_manual",
    "manual_arima": "statistical_manual",
    "auto_arima": "statistical_auto",
    "auto_ets": "statistical_auto",
    "auto_theta": "statistical_auto",
}

MODEL_NOTES = {
    "naive": "y at the cutoff for every step; one look-up a window.",
    "seasonal_naive_24": "y one season of 24 positions before, the last season cycled beyond it; look-ups only.",
    "seasonal_naive_168": "The same with a season of 168 positions.",
    "window_average_168": "Average of the 168 positions up to the cutoff, equal for all steps.",
    "seasonal_window_average": "Average of the look-ups of the naive season over several seasons back.",
    "drift": "Straight line through the first and the last training value.",
    "manual_ets_additive": "Level, slope and season smoothed with weights of least one-step squared error.",
    "manual_theta_24": "Smoothed level plus half the slope of a least-squares line, phase factors of 24.",
    "manual_arima": "One difference, one lag, one error term; least conditional sum of squares.",
    "auto_arima": "Of four pairs of lag and error orders the one of least AICc.",
    "auto_ets": "With or without slope and season, whichever has the least AICc.",
    "auto_theta": "Without, with added or with multiplied phases, by least AICc.",
    "ridge_regression": "MLlib linear regression with an L2 term, fed back step by step.",
    "random_forest": "MLlib forest of regression trees, fed back step by step.",
    "hist_gradient_boosting": "MLlib boosted regression trees, fed back step by step.",
    "direct_window": "One ridge solution for each of the 24 steps from the last 168 scaled values.",
}


def _dimension(spark, mapping: Mapping[str, str], key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{key} string, {value} string")


def selection_table(board: DataFrame, group: str | Mapping[str, str] = STATISTICAL_GROUPS,
                    default_group: str = "statistical", best_label: str = "primary candidate",
                    other_label: str = "comparison model") -> DataFrame:
    """E-8: leaderboard + group + comment + decision (rank 1 → primary)."""
    spark = board.sparkSession
    out = board
    if isinstance(group, str):
        out = out.withColumn("group", F.lit(group))
    else:
        dim = _dimension(spark, group, "model", "_grp")
        out = out.join(F.broadcast(dim), "model", "left").withColumn("group", F.coalesce("_grp", F.lit(default_group))).drop("_grp")
    notes = _dimension(spark, MODEL_NOTES, "model", "comment")
    out = out.join(F.broadcast(notes), "model", "left").withColumn("comment", F.coalesce("comment", F.lit("")))
    out = out.withColumn("decision", F.when(F.col("rank") == 1, F.lit(best_label)).otherwise(F.lit(other_label)))
    lead = [c for c in ("unique_id",) if c in out.columns]
    return out.select(*lead, "rank", "group", "model", *METRIC_COLUMNS, "comment", "decision")


def combine_leaderboards(*boards: DataFrame, by: Sequence[str] = ("unique_id",)) -> DataFrame:
    """E-9 / U-1: union by name, drop NULL sMAPE, re-rank across groups."""
    out = boards[0]
    for b in boards[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    out = out.dropna(subset=["smape"]).drop("rank")
    return rank_models(out, by).select(*by, "rank", "group", "model", *METRIC_COLUMNS)


def combine_selection_tables(selections: Sequence[DataFrame], board: DataFrame,
                             best_label: str = "primary data-driven candidate",
                             other_label: str = "comparison model") -> DataFrame:
    """J-4 / E-9: selection tables of several groups re-attached to a combined,
    re-ranked leaderboard. Old metric columns are dropped before a right join
    on (group, model), so the row set is the leaderboard's and comments come
    from the selection tables."""
    sel = selections[0]
    for s in selections[1:]:
        sel = sel.unionByName(s, allowMissingColumns=True)
    lead = [c for c in ("unique_id",) if c in board.columns]
    keys = lead + ["group", "model"]
    sel = sel.select(*keys, "comment")
    out = sel.join(board, keys, "right")
    decision = F.when(F.col("rank") == 1, F.lit(best_label)).otherwise(F.lit(other_label))
    return out.select(*lead, "rank", "group", "model", "mae", "rmse", "smape", "mase",
                      F.coalesce("comment", F.lit("")).alias("comment"), decision.alias("decision"))


def normalise_model_name(c: str = "model") -> F.Column:
    """P-11 / X-7: strip underscores, lower-case, map known aliases."""
    key = F.lower(F.regexp_replace(F.col(c), "_", ""))
    # Alias map of automatic and network model names.
    aliases = {"autoarima": "auto_arima", "autoets": "auto_ets", "autotheta": "auto_theta",
               "mlp": "neural_mlp", "neuralmlp": "neural_mlp", "nbeats": "nbeats", "nhits": "nhits"}
    mapping = F.create_map(*[x for kv in aliases.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.element_at(mapping, key), F.lower(F.col(c)))


def melt_forecasts(wide: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """M-1: wide per-model columns → long ``model, y_pred``."""
    value_cols = [c for c in wide.columns if c not in id_cols]
    long = wide.unpivot(list(id_cols), value_cols, "raw_model", "y_pred")
    return long.withColumn("model", normalise_model_name("raw_model")).drop("raw_model")


def split_interval_columns(wide: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """M-2: columns named ``<model>``, ``<model>-lo-80``, ``<model>-hi-95`` … →
    long rows ``model, y_pred, lower_80, upper_80, lower_95, upper_95``."""
    value_cols = [c for c in wide.columns if c not in id_cols]
    long = wide.unpivot(list(id_cols), value_cols, "_col", "_val")
    pat = r"^(.*?)(?:-(lo|hi)-(\d+))?$"
    long = (long.withColumn("_model", F.regexp_extract("_col", pat, 1))
                .withColumn("_side", F.regexp_extract("_col", pat, 2))
                .withColumn("_lvl", F.regexp_extract("_col", pat, 3))
                .withColumn("_kind", F.when(F.col("_side") == "", F.lit("y_pred"))
                            .when(F.col("_side") == "lo", F.concat(F.lit("lower_"), F.col("_lvl")))
                            .otherwise(F.concat(F.lit("upper_"), F.col("_lvl")))))
    kinds = ["y_pred", "lower_80", "upper_80", "lower_95", "upper_95"]
    out = long.groupBy(*id_cols, "_model").pivot("_kind", kinds).agg(F.first("_val"))
    return out.withColumn("model", normalise_model_name("_model")).drop("_model")
