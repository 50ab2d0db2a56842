"""Isolation forest per series (N-4; Liu, Ting & Zhou 2008).

No MLlib class exists, so the forest is three Spark stages:

1. **Sub-sampling** — every valid row draws, for each tree, a hash-based
   uniform number; it joins tree ``t`` when that number is below
   ``2·ψ/n`` (a JVM higher-order filter, no explode of rows × trees). Each
   (series, tree) then keeps its ``ψ`` smallest draws: an exact uniform
   sub-sample, and the group is bounded (≈ 2ψ rows).
2. **Tree building** — ``groupBy(series, tree).applyInPandas`` grows one
   random isolation tree (depth limit ``ceil(log2 ψ)``) from its ≤ ψ rows and
   returns it as flat node arrays (≤ 2ψ−1 nodes).
3. **Scoring** — rows are cut into blocks of positions; the series' forest is
   replicated once per block and ``cogroup(...).applyInPandas`` scores each
   block with numpy. Score ``s = 2^(−E[h(x)]/c(ψ))``; the flag is
   ``s > 99th percentile of s`` in the series (contamination 1 %), and the
   reported score is ``s − that percentile`` (the reference's ``−decision``).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tspanel.config import AnomalyConfig
from tspanel.operators.features import ISOLATION_FEATURES, isolation_features
from tspanel.operators.quantiles import exact_quantiles
from tspanel.operators.windowing import bucket_of
from tspanel.session import materialize

EULER = 0.5772156649015329
SCORE_BLOCK = 8192
TREE_SCHEMA = ("unique_id string, tree int, feature array<int>, threshold array<double>, "
               "left array<int>, right array<int>, size array<int>")


def avg_path(k) -> np.ndarray:
    """c(k): average path length of an unsuccessful BST search."""
    k = np.asarray(k, dtype=float)
    out = np.zeros_like(k)
    out[k == 2] = 1.0
    big = k > 2
    out[big] = 2.0 * (np.log(k[big] - 1.0) + EULER) - 2.0 * (k[big] - 1.0) / k[big]
    return out


def build_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    feature, threshold, left, right, size = [], [], [], [], []

    def grow(idx: np.ndarray, depth: int) -> int:
        node = len(feature)
        feature.append(-1); threshold.append(0.0); left.append(-1); right.append(-1); size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return node
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            return node
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        feature[node] = f
        threshold[node] = thr
        left[node] = grow(idx[go_left], depth + 1)
        right[node] = grow(idx[~go_left], depth + 1)
        return node

    grow(np.arange(len(x)), 0)
    return feature, threshold, left, right, size


def path_lengths(x: np.ndarray, tree) -> np.ndarray:
    feature, threshold, left, right, size = (np.asarray(a) for a in tree)
    node = np.zeros(len(x), dtype=int)
    depth = np.zeros(len(x))
    active = feature[node] >= 0
    while active.any():
        f = feature[node[active]]
        go_left = x[active, f] < threshold[node[active]]
        node[active] = np.where(go_left, left[node[active]], right[node[active]])
        depth[active] += 1
        active = feature[node] >= 0
    return depth + avg_path(size[node])


def isolation_forest(panel: DataFrame, config: AnomalyConfig = AnomalyConfig(),
                     features: list[str] = ISOLATION_FEATURES) -> DataFrame:
    """N-4: ``unique_id, pos, isolation_score, isolation_anomaly`` of every row (rows with
    incomplete features: NULL score, not flagged)."""
    psi, n_trees, seed = config.sample_size, config.n_trees, config.seed
    feats = materialize(isolation_features(panel).dropna(subset=features).select("unique_id", "pos", *features))
    counts = feats.groupBy("unique_id").agg(F.count(F.lit(1)).alias("_n"))
    rows = feats.join(counts, "unique_id")

    # 1. per-tree sub-samples
    def draw(t):
        return (F.xxhash64(F.col("unique_id"), F.col("pos"), t, F.lit(seed)) % F.lit(1 << 30)).cast("double") / F.lit(float(1 << 30))
    p = F.least(F.lit(1.0), F.lit(2.0 * psi) / F.col("_n"))
    trees = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.abs(draw(t)) < p)
    picked = rows.withColumn("tree", F.explode(trees)).withColumn("_u", F.abs(draw(F.col("tree"))))
    rank = F.row_number().over(Window.partitionBy("unique_id", "tree").orderBy("_u", "pos"))
    sample = picked.withColumn("_r", rank).filter(F.col("_r") <= psi)

    # 2. grow trees (bounded groups)
    def grow_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        uid, t = pdf["unique_id"].iloc[0], int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, t, zlib.crc32(str(uid).encode())])
        tree = build_tree(pdf[features].to_numpy(dtype=float), rng, math.ceil(math.log2(max(2, len(pdf)))))
        return pd.DataFrame({"unique_id": [uid], "tree": [t], "feature": [tree[0]], "threshold": [tree[1]],
                             "left": [tree[2]], "right": [tree[3]], "size": [tree[4]]})

    forest = sample.groupBy("unique_id", "tree").applyInPandas(grow_fn, TREE_SCHEMA)

    # 3. score blocks against the replicated forest
    blocks = rows.withColumn("_blk", bucket_of(F.col("pos"), SCORE_BLOCK))
    spans = (feats.groupBy("unique_id").agg(F.min("pos").alias("_a"), F.max("pos").alias("_b"))
                  .select("unique_id", F.explode(F.sequence(bucket_of(F.col("_a"), SCORE_BLOCK),
                                                            bucket_of(F.col("_b"), SCORE_BLOCK))).alias("_blk")))
    forest_blocks = forest.join(spans, "unique_id")

    def score_fn(x_pdf: pd.DataFrame, f_pdf: pd.DataFrame) -> pd.DataFrame:
        if x_pdf.empty:
            return pd.DataFrame({"unique_id": [], "pos": [], "_s": []})
        x = x_pdf[features].to_numpy(dtype=float)
        total = np.zeros(len(x))
        for rec in f_pdf.itertuples(index=False):
            total += path_lengths(x, (rec.feature, rec.threshold, rec.left, rec.right, rec.size))
        mean_path = total / max(len(f_pdf), 1)
        c_psi = float(avg_path([max(s[0] for s in f_pdf["size"])])[0])       # a short series has fewer than sample_size rows a tree
        return pd.DataFrame({"unique_id": x_pdf["unique_id"].to_numpy(), "pos": x_pdf["pos"].to_numpy(),
                             "_s": np.power(2.0, -mean_path / c_psi)})

    scored = (blocks.groupBy("unique_id", "_blk")
              .cogroup(forest_blocks.groupBy("unique_id", "_blk"))
              .applyInPandas(score_fn, "unique_id string, pos long, _s double"))
    scored = materialize(scored)    # read by the threshold and the flag join: score once
    q = 1.0 - config.isolation_contamination
    thr = exact_quantiles(scored, ["unique_id"], "_s", [q], out="_t").withColumnRenamed("_t_0", "_thr")
    flagged = scored.join(thr, "unique_id").select("unique_id", "pos", (F.col("_s") - F.col("_thr")).alias("isolation_score"),
                                                   (F.col("_s") > F.col("_thr")).alias("isolation_anomaly"))
    return (panel.select("unique_id", "pos").join(flagged, ["unique_id", "pos"], "left")
                 .withColumn("isolation_anomaly", F.coalesce("isolation_anomaly", F.lit(False))))
