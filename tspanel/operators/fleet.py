"""Fleets of statistical models over whole series (F-13..F-17).

Every model is a linear recurrence with a few parameters (``recurrence.py``), so
a fit needs no series in one task:

1. The panel is packed once into blocks (one row each, with the few rows before
   and after that a moving average or a lag needs).
2. One pass adds up what Theta needs at every cutoff: lag products (is there a
   season?), detrended sums by phase (the indices of a classical decomposition)
   and products with time (the slope).
3. Parameter points are rows of a plan by series. Each round, every block works
   out all points of its series; blocks are composed by (series, points) into
   the sum of squares and the state at every cutoff; the best point of every
   (window, specification) starts a finer round. Coarse grids are shared by all
   windows: a row is swept once for all windows that contain it.
4. Forecasts come from the states. The automatic models take the specification
   of smallest AICc, all on the same sample and scale; bands use the model's own
   variance of the h-step error.

A task holds one block, the composed rows of ``CHUNK`` points (some 50 numbers a
point and block), or the best points of one series.

Specifications (estimators differ from likelihood optimisers, as documented):
exponential smoothing with or without trend and season, started from the first
two seasons and scored from the second season on; Theta (two lines) without
season, additive and multiplicative; ARIMA(p, 1, q) with p, q up to 1 by
conditional sum of squares. A specification that cannot be fitted gives rows
without forecast and says why in ``error``; the others go on (F-17). Missing
values before the cutoff are such a reason.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tspanel.config import BUCKET_STEPS, DAILY_SEASON, HORIZON
from tspanel.operators import recurrence as R
from tspanel.operators import windowing as hw
from tspanel.session import materialize

FLEET_MODELS = ("manual_ets_additive", "manual_theta_24", "manual_arima", "auto_ets", "auto_theta", "auto_arima")
Z = {80: 1.2815515655446004, 95: 1.959963984540054}
#: Standard normal quantile of the test for a season (two-sided, 90 %).
SEASON_LIMIT = 1.6448536269514722

#: Rounds of refinement after the coarse grid; each halves the steps.
ROUNDS = 5
CHUNK = 16

# Specifications: exponential smoothing by (trend, season), Theta by kind of season, ARIMA by (p, q).
ETS = {0: (False, False), 1: (True, False), 2: (False, True), 3: (True, True)}
THETA = {4: "none", 5: "additive", 6: "multiplicative"}
ARIMA = {7: (0, 0), 8: (1, 0), 9: (0, 1), 10: (1, 1)}
FAMILY = {**dict.fromkeys(ETS, "auto_ets"), **dict.fromkeys(THETA, "auto_theta"), **dict.fromkeys(ARIMA, "auto_arima")}

# Columns of a parameter point; the seasonal indices of Theta follow. Window -1: all windows.
SPEC, WIN, P0, P1, P2, SLOPE, INDEX = range(7)


# ---------------------------------------------------------------- blocks

def pack(panel: DataFrame, season: int, bucket: int) -> DataFrame:
    """One row a block: ``unique_id, _bkt, start`` (position of the first value) and ``ys`` with the halo."""
    halo = max(season, 2)
    d = hw.with_halo(panel.select("unique_id", "pos", "y"), halo, halo, bucket)
    packed = d.where(F.col(hw.BKT) >= 0).groupBy("unique_id", hw.BKT).agg(F.array_sort(F.collect_list(F.struct("pos", "y"))).alias("_r"))
    return packed.select("unique_id", hw.BKT, F.col("_r")[0]["pos"].alias("start"),
                         F.transform("_r", lambda r: F.coalesce(r["y"].cast("double"), F.lit(float("nan")))).alias("ys"))


def _own(ys: np.ndarray, start: int, block: int, bucket: int) -> tuple[np.ndarray, int]:
    """The values with their halo and the offset of the block's first own row."""
    return np.asarray(ys, float), block * bucket + 1 - int(start)


# ---------------------------------------------------------------- what Theta needs at every cutoff

def _cells(season: int) -> dict[str, slice]:
    """Places of the sums in one vector."""
    names = [("lag", season + 1), ("head", season), ("tail", season), ("sum", 1), ("bad", 1), ("n", season), ("y", season), ("ty", season),
             ("na", season), ("add", season), ("mult", season)]
    out, at = {}, 0
    for name, width in names:
        out[name] = slice(at, at + width)
        at += width
    out["size"] = slice(at, at)
    return out


def theta_sums(ys: np.ndarray, start: int, block: int, bucket: int, cut: int, season: int, centre: float) -> np.ndarray:
    """The sums of one block over its own positions up to ``cut``."""
    at = _cells(season)
    y, off = _own(ys, start, block, bucket)
    pos = int(start) + np.arange(len(y))
    own = np.arange(off, min(len(y), off + bucket, cut - int(start) + 1))
    out = np.zeros(at["size"].start)
    z, phase = y - centre, (pos - 1) % season
    for k in range(season + 1):
        rows = own[pos[own] > k]
        out[at["lag"]][k] = z[rows] @ z[rows - k]
    early, late = own[pos[own] <= season], own[pos[own] > cut - season]
    np.add.at(out[at["head"]], pos[early] - 1, z[early])
    np.add.at(out[at["tail"]], cut - pos[late], z[late])
    out[at["sum"]], out[at["bad"]] = z[own].sum(), (y[own] <= 0).sum()
    for name, v in (("n", np.ones(len(own))), ("y", y[own]), ("ty", y[own] * (pos[own] - 1.0))):
        out[at[name]] = np.bincount(phase[own], v, season)
    half = season // 2
    weights = np.r_[0.5, np.ones(season - 1), 0.5] / season if season % 2 == 0 else np.ones(season) / season
    inner = own[(pos[own] > half) & (pos[own] + half <= cut)]
    if len(inner):
        trend = np.convolve(y, weights, mode="valid")[inner - half]
        out[at["na"]] = np.bincount(phase[inner], minlength=season)
        out[at["add"]] = np.bincount(phase[inner], y[inner] - trend, season)
        with np.errstate(all="ignore"):
            out[at["mult"]] = np.bincount(phase[inner], y[inner] / trend, season)
    return out


def theta_facts(sums: np.ndarray, cut: int, season: int) -> tuple[int, list[tuple[int, float, np.ndarray]]]:
    """The specification that the test for a season chooses, and (specification, slope, indices) of every possible one."""
    at, n = _cells(season), float(cut)
    mean = sums[at["sum"]][0] / n
    head, tail = np.cumsum(sums[at["head"]]), np.cumsum(sums[at["tail"]])
    total = sums[at["sum"]][0]
    cov = [sums[at["lag"]][0] - n * mean * mean]
    for k in range(1, season + 1):
        ahead, behind = total - head[k - 1], total - tail[k - 1]
        cov.append(sums[at["lag"]][k] - mean * (ahead + behind) + (n - k) * mean * mean)
    seasonal = False
    if cut >= 2 * season and cov[0] > 0:
        r = np.array(cov[1:]) / cov[0]
        seasonal = bool(abs(r[-1]) / np.sqrt((1 + 2 * np.sum(r[:-1] ** 2)) / n) > SEASON_LIMIT)
    counts, by_time = sums[at["n"]], sums[at["ty"]]
    t_mean, t_square = (n - 1) / 2.0, n * (n * n - 1) / 12.0
    phases = np.arange(season)
    t_of = counts * phases + season * counts * (counts - 1) / 2.0          # sum of t by phase

    def slope(adj_t: float, adj: float) -> float:
        return (adj_t - t_mean * adj) / t_square if t_square > 0 else 0.0

    out = [(4, slope(by_time.sum(), sums[at["y"]].sum()), np.zeros(season))]
    if cut >= 2 * season and (sums[at["na"]] > 0).all():
        s = sums[at["add"]] / sums[at["na"]]
        s = s - s.mean()
        out.append((5, slope(by_time.sum() - s @ t_of, sums[at["y"]].sum() - s @ counts), s))
        if sums[at["bad"]][0] == 0:
            s = sums[at["mult"]] / sums[at["na"]]
            s = s / s.mean()
            out.append((6, slope((by_time / s).sum(), (sums[at["y"]] / s).sum()), s))
    return (out[-1][0] if seasonal and len(out) > 1 else 4), out


# ---------------------------------------------------------------- parameter points

def _points(spec: int, win: int, params, slope: float, index: np.ndarray) -> np.ndarray:
    params = np.unique(np.atleast_2d(np.asarray(params, float)), axis=0)
    fixed = np.r_[slope, index]
    return np.hstack([np.full((len(params), 1), spec), np.full((len(params), 1), win), params, np.tile(fixed, (len(params), 1))])


def _limits(spec: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower and upper end of each parameter and the first step of the refinement (0: fixed)."""
    if spec in ETS:
        trend, season = ETS[spec]
        return np.array([0.001, 0, 0]), np.array([0.999, 0.999 * trend, 0.999 * season]), np.array([0.12, 0.12 * trend, 0.15 * season])
    if spec in THETA:
        return np.array([0.001, 0, 0]), np.array([0.999, 0, 0]), np.array([0.05, 0, 0])
    p, q = ARIMA[spec]
    return np.array([-0.995 * p, -0.995 * q, 0]), np.array([0.995 * p, 0.995 * q, 0]), np.array([0.08 * p, 0.08 * q, 0])


def _coarse(spec: int) -> list[tuple[float, float, float]]:
    if spec in ETS:
        trend, season = ETS[spec]
        return list(itertools.product((0.02, 0.25, 0.5, 0.75, 0.98), (0.0, 0.15, 0.4) if trend else (0.0,), (0.0, 0.3, 0.6, 0.9) if season else (0.0,)))
    if spec in THETA:
        return [(a, 0.0, 0.0) for a in np.linspace(0.01, 0.99, 12)]
    p, q = ARIMA[spec]
    grid = np.linspace(-0.9, 0.9, 12)
    return list(itertools.product(grid if p else (0.0,), grid if q else (0.0,), (0.0,)))


def _finer(spec: int, best: np.ndarray, done: int) -> np.ndarray:
    lo, hi, step = _limits(spec)
    moves = np.array(list(itertools.product(*[(-1, 0, 1) if s > 0 else (0,) for s in step])))
    return np.clip(best + moves * step / 2.0 ** done, lo, hi)


def _first_points(season: int, specs: tuple[int, ...]):
    """Per series: cutoffs, what the test for a season chose, and the coarse grids."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cut", "window"])
        cuts, none = pdf["cut"].to_numpy(), np.zeros(season)
        cand, chosen = [_points(s, -1, _coarse(s), 0.0, none) for s in specs if s not in THETA], []
        for w, (cut, sums) in enumerate(zip(cuts, pdf["sums"])):
            told, kinds = theta_facts(np.asarray(sums, float), int(cut), season)
            chosen.append(told)
            cand += [_points(s, w, _coarse(s), slope, index) for s, slope, index in kinds if s in specs]
        return pd.DataFrame({"unique_id": [pdf["unique_id"].iloc[0]], "cuts": [cuts.tolist()], "windows": [pdf["window"].tolist()], "chosen": [chosen],
                             "cand": [np.vstack(cand).ravel().tolist()], "best": [[]]})
    return run


PLAN = "unique_id string, cuts array<long>, windows array<int>, chosen array<int>, cand array<double>, best array<double>"


# ---------------------------------------------------------------- sweeping blocks

def _sweep(spec: int, c: np.ndarray, y: np.ndarray, off: int, length: int, first_block: bool, season: int, stops: list[int]):
    """All points of one specification over a block's own rows (``y`` has the halo, ``off`` is the first own row)."""
    k, x = len(c), y[off:off + length]
    if spec in ARIMA:
        step = np.diff(y, prepend=np.nan)
        begin = 2 if first_block else 0
        rows = off + np.arange(length)
        w, before = step[rows], step[np.maximum(rows - 1, 0)]
        return R.residuals(w, before, c[:, P0], c[:, P1], np.zeros((1, k, 1)) if first_block else R.unknown(1, k), begin, stops)
    trend, seasonal = ETS.get(spec, (False, False))
    period = season if seasonal else 1
    weight, counted = np.ones((k, 1)), 0
    if spec in THETA and spec != 4:
        index = c[:, INDEX:][:, np.arange(length) % season]
        x = x / index if spec == 6 else x - index
        weight = c[:, INDEX:] if spec == 6 else weight
    x = np.broadcast_to(x, (k, length))
    gain = np.column_stack([c[:, P0], c[:, P0] * c[:, P1], c[:, P2]])
    begin, enter = 0, None
    if first_block:
        enter, begin, counted = np.zeros((2 + period, k, 1)), period if seasonal else 1, season if spec in ETS else 1
        if seasonal and length >= 2 * season:
            enter[0] = x[:, :season].mean(axis=1, keepdims=True)
            if trend:
                enter[1] = (x[:, season:2 * season].mean(axis=1, keepdims=True) - enter[0]) / season
            enter[2:] = (x[:, :season, None] - enter[0][:, None]).transpose(1, 0, 2)
        elif not seasonal:
            enter[0] = x[:, :1]
            if trend and length > 1:
                enter[1] = x[:, 1:2] - x[:, :1]
    else:
        enter = R.unknown(2 + period, k)
    return R.smoothing(x, gain, period, enter, begin, counted, weight, stops)


SWEPT = ("unique_id string, chunk int, point int, block long, win int, v array<double>, q array<double>, a array<double>, p array<double>, "
         "last array<double>")


def _sweep_block(season: int, bucket: int):
    """Swept points of one block: a row a point for the whole block (window -1), and one for every cutoff in it."""
    width = INDEX + season

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        block, cuts = int(r[hw.BKT]), np.asarray(r["cuts"])
        c = np.asarray(r["cand"], float).reshape(-1, width)
        y, off = _own(r["ys"], r["start"], block, bucket)
        low, length = block * bucket, min(bucket, len(y) - off)
        here = {w: int(cut - low) for w, cut in enumerate(cuts) if low < cut <= low + bucket}
        beyond = {w for w, cut in enumerate(cuts) if cut > low + bucket}
        out = []
        for spec in np.unique(c[:, SPEC]).astype(int):
            ids = np.flatnonzero(c[:, SPEC] == spec)
            asked = c[ids, WIN].astype(int)
            live = np.isin(asked, list(here) + list(beyond)) | ((asked < 0) & bool(here or beyond))
            ids, asked = ids[live], asked[live]
            if not len(ids):
                continue
            stops = sorted(set(here.values()) | ({bucket} if beyond else set()))
            with np.errstate(all="ignore"):
                for stop, state, squares in _sweep(spec, c[ids], y, off, length, block == 0, season, stops):
                    ends = [w for w, at in here.items() if at == stop] + ([-1] if stop == bucket and beyond else [])
                    last = y[max(0, off + stop - 2):off + stop].tolist()
                    for i, (point, only) in enumerate(zip(ids, asked)):
                        for w in ends:
                            if w >= 0 and only not in (-1, w) or w < 0 <= only and only not in beyond:
                                continue
                            shared = block > 0 and (w >= 0 or block == 1)        # the same for all later whole blocks
                            out.append((r["unique_id"], int(point) // CHUNK, int(point), block, w, state[i, :, -1], squares[i, -1],
                                        state[i, :, :-1].ravel() if shared else [], squares[i, :-1, :-1].ravel() if shared else [], last if w >= 0 else []))
        return pd.DataFrame(out, columns=["unique_id", "chunk", "point", "block", "win", "v", "q", "a", "p", "last"])
    return run


COMPOSED = "unique_id string, point int, win int, sse double, state array<double>, last array<double>"


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sum of squares and state of every (point, cutoff) from the blocks up to it."""
    out = []
    for point, g in pdf.sort_values(["block", "win"], ascending=[True, False]).groupby("point", sort=False):
        state, sse, whole = None, 0.0, None
        for block, win, v, q, a, p, last in g[["block", "win", "v", "q", "a", "p", "last"]].itertuples(index=False):
            v, q = np.asarray(v, float), np.asarray(q, float)
            if block == 0:
                reached, total = v, float(q[-1])
            else:
                maps = (np.asarray(a, float).reshape(len(v), -1), np.asarray(p, float).reshape(len(v), -1)) if len(a) else whole
                reached, total = R.advance(state, sse, maps[0], v, maps[1], q)
            if win >= 0:
                out.append((pdf["unique_id"].iloc[0], int(point), int(win), total, reached.tolist(), list(last)))
            else:       # the whole block, after the cutoffs inside it
                if block > 0:
                    whole = maps
                state, sse = reached, total
    return pd.DataFrame(out, columns=["unique_id", "point", "win", "sse", "state", "last"])


def _choose(season: int, done: int):
    """Best point of every (window, specification) and the finer points around it."""
    width = INDEX + season

    def run(plan: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        c = np.asarray(plan["cand"].iloc[0], float).reshape(-1, width)
        best, finer = [], []
        got = got[np.isfinite(got["sse"])]
        if len(got):
            got = got.assign(spec=c[got["point"], SPEC].astype(int)).sort_values(["sse", "point"])
            for (spec, win), g in got.groupby(["spec", "win"]):
                r = g.iloc[0]
                p = c[int(r["point"])]
                state = np.zeros(2 + season)
                state[:len(r["state"])] = r["state"]
                last = np.zeros(2)
                last[2 - len(r["last"]):] = r["last"]
                best.append(np.r_[p[:WIN], win, p[P0:], r["sse"], state, last])
                finer.append(_points(spec, win, _finer(spec, p[P0:SLOPE], done), p[SLOPE], p[INDEX:]))
        plan = plan[["unique_id", "cuts", "windows", "chosen"]].copy()
        plan["cand"] = [np.vstack(finer).ravel().tolist() if finer else []]
        plan["best"] = [np.vstack(best).ravel().tolist() if best else []]
        return plan
    return run


# ---------------------------------------------------------------- forecasts

FITTED = ("unique_id string, window int, cut long, spec int, wanted int, sse double, nobs long, k int, params array<double>, "
          "preds array<double>, factors array<double>, error string")


def _forecast(spec: int, p: np.ndarray, state: np.ndarray, last: np.ndarray, cut: int, season: int, horizon: int):
    """Forecasts, variance factors, number of scored errors and of parameters."""
    i = np.arange(1, horizon + 1)
    phase = (cut + i - 1) % season
    if spec in ETS:
        trend, seasonal = ETS[spec]
        pred = state[0] + i * state[1] + (state[2 + phase] if seasonal else state[2])
        effect = p[P0] * (1 + p[P1] * i) + p[P2] * (i % season == 0)              # of an error on the value i steps later
        k = 2 + 2 * trend + seasonal * (1 + season)
        return pred, 1 + np.r_[0.0, np.cumsum(effect ** 2)[:-1]], cut - season, k
    if spec in THETA:
        a = p[P0]
        pred = state[0] + p[SLOPE] / 2 * (i - 1 + (1 - (1 - a) ** cut) / a)
        factor, index = 1 + (i - 1) * a * a, p[INDEX:][phase]
        if spec == 6:
            return pred * index, factor, cut - 1, 3 + season
        return pred + index, factor, cut - 1, 3 + season * (spec == 5)
    phi, theta = p[P0], p[P1]
    w = last[1] - state[1] if len(state) > 1 and np.isfinite(state[1]) else 0.0
    steps = (phi * w + theta * state[0]) * phi ** (i - 1.0)
    weights = np.cumsum(np.r_[1.0, (phi + theta) * phi ** np.arange(horizon - 1.0)])
    return last[1] + np.cumsum(steps), np.cumsum(weights ** 2), cut - 2, 1 + sum(ARIMA[spec])


def _read_out(season: int, horizon: int, specs: tuple[int, ...]):
    """A row for every (window, specification): fitted, or the reason why not."""
    size = INDEX + season

    def run(batches):
        for pdf in batches:
            out = []
            for uid, cuts, windows, chosen, best in pdf[["unique_id", "cuts", "windows", "chosen", "best"]].itertuples(index=False):
                rows = {(int(r[SPEC]), int(r[WIN])): r for r in np.asarray(best, float).reshape(-1, size + 3 + season + 2)}
                for w, (cut, window, told) in enumerate(zip(cuts, windows, chosen)):
                    for spec in specs:
                        r, need = rows.get((spec, w)), 2 * season if spec in ETS or spec in (5, 6) else 4
                        row = [uid, int(window), int(cut), spec, int(told)]
                        if cut < need:
                            out.append([*row, None, None, None, None, None, None, f"needs {need} observations, has {cut}"])
                        elif r is None:
                            out.append([*row, None, None, None, None, None, None, "missing values or no fit for these values"])
                        else:
                            state, last = r[size + 1:size + 3 + season], r[-2:]
                            if spec in ARIMA:
                                state = np.r_[state[0], last[0]]
                            pred, factor, nobs, k = _forecast(spec, r[:size], state, last, int(cut), season, horizon)
                            ok = bool(np.isfinite(pred).all())
                            out.append([*row, float(r[size]), int(nobs), int(k), r[P0:SLOPE].tolist(), pred.tolist() if ok else None, factor.tolist(),
                                        None if ok else "forecast is not finite"])
            yield pd.DataFrame(out, columns=["unique_id", "window", "cut", "spec", "wanted", "sse", "nobs", "k", "params", "preds", "factors", "error"])
    return run


def aicc(sse: Column, n: Column, k: Column) -> Column:
    """Corrected information criterion; NULL where it does not exist."""
    left = n - k - 1
    return F.when((left > 0) & (sse > 0), n * F.log(sse / n) + 2 * k + 2 * k * (k + 1) / left)


def fit_specifications(panel: DataFrame, cutoffs: DataFrame, horizon: int = HORIZON, season: int = DAILY_SEASON,
                       specs: tuple[int, ...] = tuple(FAMILY), bucket: int = BUCKET_STEPS) -> DataFrame:
    """Every specification fitted on positions 1..cut of every (series, window).

    Returns ``unique_id, window, cut, spec, wanted`` (Theta's specification by the test for a season), ``sse, nobs, k,
    params, preds, factors, error``; the arrays have one value a step.
    """
    if season < 2:
        raise ValueError("a season has at least two steps")
    bucket = season * max(4, -(-bucket // season))
    blocks = materialize(pack(panel, season, bucket))
    cuts = cutoffs.select("unique_id", F.col("window").cast("int").alias("window"), F.col("cut").cast("long").alias("cut")).where("cut > 0")
    centre = panel.groupBy("unique_id").agg(F.coalesce(F.avg("y"), F.lit(0.0)).alias("centre"))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        parts = []
        for c in r["cs"]:
            v = theta_sums(r["ys"], r["start"], int(r[hw.BKT]), bucket, int(c["cut"]), season, float(r["centre"]))
            parts.append(pd.DataFrame({"unique_id": r["unique_id"], "window": c["window"], "cut": c["cut"], "cell": np.arange(len(v), dtype="int32"), "v": v}))
        return pd.concat(parts)

    lists = cuts.groupBy("unique_id").agg(F.collect_list(F.struct("window", "cut")).alias("cs"))
    low = F.col(hw.BKT) * F.lit(bucket)
    asked = (blocks.join(lists.join(centre, "unique_id"), "unique_id").withColumn("cs", F.filter("cs", lambda c: c["cut"] > low))
             .where(F.size("cs") > 0).groupBy("unique_id", hw.BKT))
    cells = asked.applyInPandas(sums, "unique_id string, window int, cut long, cell int, v double")
    added = cells.groupBy("unique_id", "window", "cut", "cell").agg(F.sum("v").alias("v"))
    vectors = added.groupBy("unique_id", "window", "cut").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", "v"))), lambda r: r["v"]).alias("sums"))
    plan = materialize(vectors.groupBy("unique_id").applyInPandas(_first_points(season, specs), PLAN))
    for done in range(ROUNDS + 1):
        swept = (blocks.join(plan.select("unique_id", "cuts", "cand"), "unique_id").where(low < F.array_max("cuts"))
                 .groupBy("unique_id", hw.BKT).applyInPandas(_sweep_block(season, bucket), SWEPT))
        composed = swept.groupBy("unique_id", "chunk").applyInPandas(_compose, COMPOSED)
        plan = materialize(plan.groupBy("unique_id").cogroup(composed.groupBy("unique_id")).applyInPandas(_choose(season, done), PLAN))
    return plan.mapInPandas(_read_out(season, horizon, specs), FITTED)


def fleet_forecasts(panel: DataFrame, cutoffs: DataFrame, horizon: int = HORIZON, season: int = DAILY_SEASON,
                    models=FLEET_MODELS, bucket: int = BUCKET_STEPS) -> DataFrame:
    """F-13..F-17 for every (series, window): ``unique_id, window, cut, horizon, model, y_pred``, 80/95 bands (NULL for
    the manual models) and ``error`` (why there is no forecast)."""
    manual = {"manual_ets_additive": F.col("spec") == 3, "manual_theta_24": F.col("spec") == F.col("wanted"), "manual_arima": F.col("spec") == 10}
    needs = {"manual_ets_additive": {3}, "manual_theta_24": set(THETA), "manual_arima": {10}}
    specs = sorted(set().union(*[needs.get(m, {s for s, f in FAMILY.items() if f == m}) for m in models]))
    fitted = materialize(fit_specifications(panel, cutoffs, horizon, season, tuple(specs), bucket))
    key, what = ["unique_id", "window", "cut"], ["preds", "factors", "sse", "nobs", "error"]
    parts = [fitted.where(rule).select(*key, F.lit(m).alias("model"), *what) for m, rule in manual.items() if m in models]
    family = F.element_at(F.create_map(*[F.lit(x) for s, f in FAMILY.items() for x in (s, f)]), F.col("spec"))
    # candidates without a criterion come last, so that a family without any fit still tells why
    score = F.struct(F.coalesce(aicc(F.col("sse"), F.col("nobs"), F.col("k")), F.lit(float("inf"))), F.col("spec"))
    auto = fitted.withColumn("model", family).where(F.col("model").isin([m for m in models if m.startswith("auto")]))
    parts.append(auto.groupBy(*key, "model").agg(F.min_by(F.struct(*what), score).alias("b")).select(*key, "model", *[f"b.{c}" for c in what]))
    told = parts[0]
    for part in parts[1:]:
        told = told.unionByName(part)
    steps = told.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    spread = F.when(F.col("model").startswith("auto"), F.sqrt(F.col("sse") / F.col("nobs") * F.get("factors", F.col("horizon") - 1)))
    steps = steps.withColumn("y_pred", F.get("preds", F.col("horizon") - 1)).withColumn("_sd", spread)
    bands = [(F.col("y_pred") + sign * z * F.col("_sd")).alias(f"{name}_{level}") for level, z in Z.items() for name, sign in (("lower", -1), ("upper", 1))]
    return steps.select(*key, "horizon", "model", "y_pred", *bands, "error")
