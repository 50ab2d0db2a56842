"""MLlib regressors on lag features (G-1..G-5, F-19, F-20, F-21).

One model per (model type, backtest window), pooled over all series of the
panel (for a one-series panel this is the reference's per-series fit). The
training rows of window ``w`` are the feature rows whose whole look-back lies
inside the last ``max_train_size`` training positions (F-19), so no feature
reads past the cutoff.

Recursive prediction (F-20) keeps per (series, window) a state array of the
last ``max_lag + 1`` values. The 24 steps are sequential by nature, so they
run inside one Arrow-batched ``mapInPandas`` pass over the state rows: each
fitted model is exported once (linear coefficients, or the tree node tables
MLlib itself writes as Parquet — bounded by trees × depth, not by data) and
evaluated with numpy, which avoids 24 dependent Spark jobs per model.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tspanel.config import DIRECT_INPUT, HORIZON, SEED, FeatureConfig
from tspanel.operators import windowing as hw
from tspanel.operators.features import feature_names, forecast_features
from tspanel.session import ensure_checkpoint_dir



# ---------------------------------------------------------------- model registry (G-5)
# Model names and their parameters.

def ridge(alpha: float = 1.0, scale: float = 1.0, standardize: bool = True) -> LinearRegression:
    """G-1: ridge on standardised features (``standardize=False``: as they are). ``scale = stddev_pop(y) / n`` maps
    the closed-form penalty α onto MLlib's ``regParam``."""
    return LinearRegression(featuresCol="features", labelCol="y", regParam=alpha * scale, elasticNetParam=0.0,
                            standardization=standardize, solver="normal")


def random_forest(num_trees: int = 120, max_depth: int = 12, min_leaf: int = 3) -> RandomForestRegressor:
    """G-2."""
    return RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=num_trees, maxDepth=min(max_depth, 30),
                                 minInstancesPerNode=min_leaf, featureSubsetStrategy="all", seed=SEED)


def boosted_trees(max_iter: int = 250, step: float = 0.05, max_depth: int = 5) -> GBTRegressor:
    """G-3 (G-4 preset: ``max_iter=500, step=0.03``)."""
    return GBTRegressor(featuresCol="features", labelCol="y", maxIter=max_iter, stepSize=step, maxDepth=max_depth,
                        maxBins=255, seed=SEED)


MODEL_REGISTRY: dict[str, Callable[..., object]] = {
    "ridge_regression": ridge,
    "random_forest": random_forest,
    "hist_gradient_boosting": boosted_trees,
}

#: The alternate presets (pass as ``registry``); ``boosted_trees`` is G-4.
ALTERNATE_MODELS: dict[str, Callable[..., object]] = {
    "ridge_regression": partial(ridge, standardize=False),
    "random_forest": partial(random_forest, num_trees=300, max_depth=30, min_leaf=2),
    "hist_gradient_boosting": partial(boosted_trees, max_iter=300),
    "boosted_trees": partial(boosted_trees, max_iter=500, step=0.03),
}


def register_model(name: str, factory: Callable[..., object]) -> None:
    """Extension point: add an MLlib estimator factory under ``name``."""
    MODEL_REGISTRY[name] = factory


# ---------------------------------------------------------------- training sets (F-19)

def tail_for_cutoffs(panel: DataFrame, cutoffs: DataFrame, keep: int | None) -> DataFrame:
    """Only the positions any window can read: ``pos > min(cut) - keep`` per
    series, so features / windows are not computed over the whole history."""
    if keep is None:
        return panel
    first = cutoffs.groupBy("unique_id").agg(F.min("cut").alias("_c0"))
    return (panel.join(first, "unique_id")
                 .filter(F.col("pos") > F.col("_c0") - F.lit(keep)).drop("_c0"))


def training_rows(features: DataFrame, cutoffs: DataFrame, config: FeatureConfig) -> DataFrame:
    """Feature rows of each window: ``lo + lookback <= pos <= cut`` with
    ``lo = max(1, cut - max_train + 1)``; incomplete rows dropped."""
    look = max(max(config.lags), max(config.rolling_windows))
    cuts = cutoffs.groupBy("unique_id").agg(F.collect_list(F.struct("window", "cut")).alias("_cs"))
    pos = F.col("pos")

    def inside(c):
        lo = F.lit(1) if config.max_train_size is None else F.greatest(F.lit(1), c["cut"] - F.lit(config.max_train_size - 1))
        return (c["cut"] >= pos) & (lo + F.lit(look) <= pos)

    d = features.join(cuts, "unique_id").withColumn("_w", F.explode(F.filter("_cs", inside)))
    d = d.withColumn("window", F.col("_w.window")).drop("_w", "_cs")
    return d.dropna(subset=feature_names(config) + ["y"])


def _assembler(config: FeatureConfig) -> VectorAssembler:
    return VectorAssembler(inputCols=feature_names(config), outputCol="features")


def fit_models(train: DataFrame, windows: list[int], models: list[str], config: FeatureConfig,
               parallel: int = 4, registry: dict[str, Callable[..., object]] | None = None) -> dict:
    """Fit one pipeline per (model, window). Every fit is a distributed MLlib
    job; the handful of independent fits are submitted from a few driver
    threads so their jobs run concurrently."""
    registry = registry or MODEL_REGISTRY
    stats = {r["window"]: (float(r["s"] or 0.0), int(r["n"])) for r in
             train.groupBy("window").agg(F.stddev_pop("y").alias("s"), F.count(F.lit(1)).alias("n")).collect()}

    def fit(key):
        name, w = key
        part = train.filter(F.col("window") == w)
        if name == "ridge_regression":
            s, n = stats.get(w, (0.0, 1))
            est = registry[name](scale=s / max(n, 1))
        else:
            est = registry[name]()
        return key, Pipeline(stages=[_assembler(config), est]).fit(part)

    keys = [(m, w) for w in windows for m in models]
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(keys)))) as pool:
        return dict(pool.map(fit, keys))


# ---------------------------------------------------------------- recursive prediction (F-20)

def initial_state(panel: DataFrame, cutoffs: DataFrame, keep: int) -> DataFrame:
    """Per (series, window): the last ``keep`` training values as an array
    (oldest first) and the cutoff timestamp."""
    cuts = cutoffs.groupBy("unique_id").agg(F.collect_list(F.struct("window", "cut")).alias("_cs"))
    pos = F.col("pos")
    d = (panel.select("unique_id", "pos", "ds", "y").join(cuts, "unique_id")
              .withColumn("_w", F.explode(F.filter("_cs", lambda c: (c["cut"] >= pos) & (c["cut"] - F.lit(keep) < pos))))
              .select("unique_id", "pos", "ds", "y", F.col("_w.window").alias("window"), F.col("_w.cut").alias("cut")))
    st = d.groupBy("unique_id", "window", "cut").agg(
        F.array_sort(F.collect_list(F.struct("pos", "y"))).alias("_s"), F.max("ds").alias("cut_ds"))
    return st.select("unique_id", "window", "cut", "cut_ds", F.transform("_s", lambda r: r["y"]).alias("hist"),
                     F.array().cast("array<double>").alias("preds"))


# ---------------------------------------------------------------- model export

def export_model(pipeline_model, path: str) -> dict:
    """A fitted pipeline as plain arrays (bounded by the model size, not the
    data): linear coefficients, or every tree's node table read back from
    MLlib's own saved Parquet format."""
    from pyspark.ml.regression import LinearRegressionModel

    est = pipeline_model.stages[-1]
    if isinstance(est, LinearRegressionModel):
        return {"kind": "linear", "coef": np.asarray(est.coefficients.toArray(), float), "intercept": float(est.intercept)}
    spark = SparkSession.getActiveSession()
    est.write().overwrite().save(path)
    nodes = (spark.read.parquet(f"{path}/data")
             .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild", "nodeData.rightChild",
                     "nodeData.split.featureIndex", F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("thr"))
             .toPandas())
    meta = spark.read.parquet(f"{path}/treesMetadata").select(F.col("_1").alias("treeID"), F.col("_3").alias("weights")).toPandas()
    trees = []
    for tid, g in nodes.groupby("treeID"):
        g = g.sort_values("id")
        ids = g["id"].to_numpy()
        index = {int(v): k for k, v in enumerate(ids)}
        left = np.array([index.get(int(c), -1) for c in g["leftChild"]])
        right = np.array([index.get(int(c), -1) for c in g["rightChild"]])
        children = set(left[left >= 0]) | set(right[right >= 0])
        root = next(k for k in range(len(ids)) if k not in children)
        trees.append({"id": int(tid), "root": root, "left": left, "right": right,
                      "feature": g["featureIndex"].fillna(-1).to_numpy(dtype=int),
                      "thr": g["thr"].fillna(0.0).to_numpy(dtype=float), "pred": g["prediction"].to_numpy(dtype=float)})
    weights = dict(zip(meta["treeID"], meta["weights"]))
    from pyspark.ml.regression import GBTRegressionModel
    combine = "sum" if isinstance(est, GBTRegressionModel) else "mean"
    return {"kind": "trees", "trees": trees, "weights": np.array([weights[t["id"]] for t in trees]), "combine": combine}


def predict_exported(model: dict, x: np.ndarray) -> np.ndarray:
    if model["kind"] == "linear":
        return x @ model["coef"] + model["intercept"]
    total = np.zeros(len(x))
    for t, wgt in zip(model["trees"], model["weights"]):
        node = np.full(len(x), t["root"])
        leaf = t["left"][node] < 0
        while not leaf.all():
            act = ~leaf
            nd = node[act]
            go_left = x[act, t["feature"][nd]] <= t["thr"][nd]
            node[act] = np.where(go_left, t["left"][nd], t["right"][nd])
            leaf = t["left"][node] < 0
        total += wgt * t["pred"][node]
    return total / len(model["trees"]) if model["combine"] == "mean" else total


# ---------------------------------------------------------------- recursive prediction (F-20)

def numpy_features(hist: np.ndarray, ds: pd.Series, config: FeatureConfig) -> np.ndarray:
    """The F-18 feature row for the next step of every state row (``hist`` is
    rows × keep, oldest first, NaN-padded on the left for short series)."""
    hour = ds.dt.hour.to_numpy(dtype=float)
    dow = ds.dt.dayofweek.to_numpy(dtype=float)
    cols = [hour, dow, ds.dt.month.to_numpy(dtype=float), (dow >= 5).astype(float),
            np.sin(2 * np.pi * hour / 24.0), np.cos(2 * np.pi * hour / 24.0),
            np.sin(2 * np.pi * dow / 7.0), np.cos(2 * np.pi * dow / 7.0)]
    for k in config.lags:
        cols.append(hist[:, -k] if k <= hist.shape[1] else np.full(len(hist), np.nan))
    for w in config.rolling_windows:
        v = hist[:, -w:]
        cnt = np.sum(~np.isnan(v), axis=1)
        ok = cnt >= max(2, w // 4)
        with np.errstate(all="ignore"):
            stats = [np.nanmean(v, axis=1), np.nanstd(v, axis=1, ddof=1), np.nanmin(v, axis=1), np.nanmax(v, axis=1)]
        for st in stats:
            cols.append(np.where(ok, st, np.nan))
    x = np.column_stack(cols)
    for j in range(1, x.shape[1]):          # previous feature in column order
        miss = np.isnan(x[:, j])
        x[miss, j] = x[miss, j - 1]
    return np.nan_to_num(x, nan=0.0)


def recursive_forecast(models: dict, state: DataFrame, horizon: int, step_seconds: int,
                       config: FeatureConfig, keep: int) -> DataFrame:
    """F-20 for every state row in one Arrow-batched pass: ``models`` maps
    (model name, window) → exported model. The exported models (bounded by
    trees × nodes, not by data) travel as one broadcast variable."""
    shared = state.sparkSession.sparkContext.broadcast(models)

    def run(it):
        models = shared.value
        for pdf in it:
            if pdf.empty:
                continue
            out = []
            for (name, win), g in ((k, pdf[pdf["window"] == k[1]]) for k in models):
                if g.empty:
                    continue
                hist = np.full((len(g), keep), np.nan)
                for r, h in enumerate(g["hist"]):
                    h = np.asarray(h, dtype=float)[-keep:]
                    hist[r, keep - len(h):] = h
                cut_ds = pd.to_datetime(g["cut_ds"]).reset_index(drop=True)
                preds = np.zeros((len(g), horizon))
                for i in range(1, horizon + 1):
                    ds = cut_ds + pd.to_timedelta(i * step_seconds, unit="s")
                    x = numpy_features(hist, ds, config)
                    p = predict_exported(models[(name, win)], x)
                    preds[:, i - 1] = p
                    hist = np.column_stack([hist[:, 1:], p])
                out.append(pd.DataFrame({
                    "unique_id": np.repeat(g["unique_id"].to_numpy(), horizon),
                    "window": np.repeat(g["window"].to_numpy(), horizon).astype("int32"),
                    "cut": np.repeat(g["cut"].to_numpy(), horizon),
                    "horizon": np.tile(np.arange(1, horizon + 1, dtype="int32"), len(g)),
                    "model": name, "y_pred": preds.ravel()}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return state.mapInPandas(run, "unique_id string, window int, cut long, horizon int, model string, y_pred double")


def ml_forecasts(panel: DataFrame, cutoffs: DataFrame, models: list[str] | None = None,
                 config: FeatureConfig = FeatureConfig(), horizon: int = HORIZON,
                 step_seconds: int = 3600, registry: dict[str, Callable[..., object]] | None = None) -> DataFrame:
    """F-19 + F-20 for every (model, series, window); ``registry`` replaces the default models."""
    models = models or list(registry or MODEL_REGISTRY)
    look = max(max(config.lags), max(config.rolling_windows))
    tail = tail_for_cutoffs(panel.select("unique_id", "ds", "y", "pos"), cutoffs, None if config.max_train_size is None else config.max_train_size + look)
    feats = forecast_features(tail, config)
    ensure_checkpoint_dir(panel.sparkSession)
    train = training_rows(feats, cutoffs, config).checkpoint(eager=True)
    windows = sorted(r["window"] for r in cutoffs.select("window").distinct().collect())
    fitted = fit_models(train, windows, models, config, registry=registry)
    keep = max(max(config.lags), max(config.rolling_windows)) + 1
    state = initial_state(panel, cutoffs, keep)
    base = ensure_checkpoint_dir(panel.sparkSession).rstrip("/")
    tag = uuid.uuid4().hex[:8]
    exported = {k: export_model(m, f"{base}/models-{tag}/{k[0]}-{k[1]}") for k, m in fitted.items()}
    return recursive_forecast(exported, state, horizon, step_seconds, config, keep)


# ---------------------------------------------------------------- direct multi-step window model (F-21)

def direct_window_forecasts(panel: DataFrame, cutoffs: DataFrame, input_size: int = DIRECT_INPUT,
                            horizon: int = HORIZON, train_size: int | None = None, alpha: float = 1.0) -> DataFrame:
    """F-21 (re-aimed network block): a direct multi-output ridge from a
    robust-scaled ``input_size`` window to the next ``horizon`` values.

    Windows come from the halo layout (``collect_list`` over a bounded frame);
    ``(x - median) / MAD`` uses the window's own inputs (MAD 0 → 1). The normal
    equations ``XᵀX`` (input_size²) and ``XᵀY`` are summed across partitions
    per backtest window, solved on the tiny matrices, and applied to each
    series' last window. Returns ``unique_id, window, cut, horizon, model, y_pred``.
    """
    span = input_size + horizon
    w = hw.series_window()
    frame = w.rowsBetween(-(input_size - 1), horizon)
    tail = tail_for_cutoffs(panel.select("unique_id", "pos", "y"), cutoffs, None if train_size is None else train_size + input_size)
    rows = hw.rolling(tail, {"_win": F.collect_list("y").over(frame)}, behind=input_size - 1, ahead=horizon)
    rows = rows.filter(F.size("_win") == span)
    # a training window ending its targets at pos + horizon belongs to backtest window w
    cuts = cutoffs.groupBy("unique_id").agg(F.collect_list(F.struct("window", "cut")).alias("_cs"))
    pos = F.col("pos")
    lo = lambda c: F.lit(1) if train_size is None else F.greatest(F.lit(1), c["cut"] - F.lit(train_size - 1))
    train = (rows.join(cuts, "unique_id")
                 .withColumn("_w", F.explode(F.filter("_cs", lambda c: (pos + F.lit(horizon) <= c["cut"])
                                                       & (pos - F.lit(input_size - 1) >= lo(c)))))
                 .select(F.col("_w.window").alias("window"), "_win"))

    def gram(it):
        sums: dict[int, np.ndarray] = {}
        for pdf in it:
            if pdf.empty:
                continue
            for wv, g in pdf.groupby("window"):
                arr = np.stack(g["_win"].to_numpy())
                x, y = _robust(arr[:, :input_size], arr[:, input_size:])
                xa = np.hstack([x, np.ones((len(x), 1))])
                cells = np.concatenate([(xa.T @ xa).ravel(), (xa.T @ y).ravel()])
                sums[int(wv)] = sums[int(wv)] + cells if int(wv) in sums else cells
        for wv, cells in sums.items():
            yield pd.DataFrame({"window": np.full(len(cells), wv, "int32"), "cell": np.arange(len(cells), dtype="int32"), "value": cells})

    # one matrix a partition and window, added up cell by cell
    parts = train.mapInPandas(gram, "window int, cell int, value double")
    sums = parts.groupBy("window", "cell").agg(F.sum("value").alias("value"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        k = input_size + 1
        cells = pdf.sort_values("cell")["value"].to_numpy()
        xtx, xty = cells[:k * k].reshape(k, k), cells[k * k:].reshape(k, horizon)
        pen = alpha * np.eye(k)
        pen[-1, -1] = 0.0
        coef = np.linalg.solve(xtx + pen, xty)
        return pd.DataFrame({"window": [int(pdf["window"].iloc[0])], "coef": [coef.ravel().tolist()]})

    coefs = sums.groupBy("window").applyInPandas(solve, "window int, coef array<double>")
    # last input window of every (series, window): positions cut - input + 1 .. cut
    state = initial_state(panel, cutoffs, input_size).select("unique_id", "window", "cut", "hist")

    def predict(it):
        for pdf in it:
            pdf = pdf[(pdf["hist"].map(len) >= input_size) & pdf["coef"].notna()]
            for wv, g in pdf.groupby("window"):
                hist = np.stack(g["hist"].to_numpy()).astype(float)
                med = np.median(hist, axis=1, keepdims=True)
                mad = np.median(np.abs(hist - med), axis=1, keepdims=True)
                mad[mad == 0] = 1.0
                xa = np.hstack([(hist - med) / mad, np.ones((len(hist), 1))])
                told = xa @ np.asarray(g["coef"].iloc[0]).reshape(input_size + 1, horizon) * mad + med
                yield pd.DataFrame({"unique_id": np.repeat(g["unique_id"].to_numpy(), horizon), "window": np.int32(wv), "cut": np.repeat(g["cut"].to_numpy(), horizon),
                                    "horizon": np.tile(np.arange(1, horizon + 1, dtype="int32"), len(g)), "y_pred": told.ravel()})

    joined = state.join(coefs, "window", "left")
    fc = joined.mapInPandas(predict, "unique_id string, window int, cut long, horizon int, y_pred double")
    return fc.withColumn("model", F.lit("direct_window"))


def _robust(x: np.ndarray, y: np.ndarray):
    med = np.median(x, axis=1, keepdims=True)
    mad = np.median(np.abs(x - med), axis=1, keepdims=True)
    mad[mad == 0] = 1.0
    return (x - med) / mad, (y - med) / mad
