"""Unit-root and level-stationarity tests over whole series (D-9, D-10).

Both tests are sums over the rows of a series, whatever its length:

* **ADF.** A row of the regression is one step, the level before it and the
  steps before it. Each bucket of a series (with its halo of earlier rows) adds
  the products of all pairs of these columns into one matrix; the matrices are
  summed by (series, cell). Every lag order is a leading part of that matrix, so
  one factorisation gives the residual sums of all orders. The refit with the
  chosen order uses a few more rows at the start, which are added afterwards.
* **KPSS.** Running sums of the deviations come from sums inside buckets and a
  carry over the buckets. The long-run variance with Bartlett weights up to lag
  ``l`` is the mean square of all sums of ``l + 1`` neighbouring deviations,
  that is of differences of running sums ``l + 1`` apart: one join by position
  for any ``l``. The bandwidth rule needs lag products up to n^(2/9) only, which
  the buckets add up along with the matrices.

A task holds one bucket, or the cells of one series (the square of the largest
lag order, which grows with the fourth root of the length).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tspanel.config import BUCKET_STEPS
from tspanel.functions import stats_math as SM
from tspanel.operators import windowing as hw
from tspanel.operators.prepare import last_n, row_numbers
from tspanel.session import materialize

_CELL = "unique_id string, i int, j int, v double"
#: Rows of cells that are no products of regressors: lag products of deviations, first values.
_LAGS, _FIRST = -1, -2


def _values(panel: DataFrame, max_points: int | None) -> DataFrame:
    """Non-null values numbered 1..n by series, with n, their mean, the largest lag order and the lags of the bandwidth rule."""
    d = panel.select("unique_id", "pos", "y").filter(F.col("y").isNotNull())
    if max_points is not None:
        d = last_n(d, max_points)
    d = materialize(row_numbers(d, "_i").select("unique_id", F.col("_i").alias("pos"), "y"))
    n = F.col("n").cast("double")
    orders = F.least(F.ceil(F.lit(12.0) * F.pow(n / 100.0, F.lit(0.25))), F.floor(n / 2.0) - 2).cast("int")
    facts = d.groupBy("unique_id").agg(F.count("*").alias("n"), F.avg("y").alias("mean"))
    facts = facts.withColumn("orders", orders).withColumn("covlags", F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("int"))
    return d.join(facts, "unique_id")


def _bucket_cells(table: pa.Table) -> pa.Table:
    """Products of all pairs of regression columns over the bucket's own rows, and its lag products."""
    table = table.sort_by("pos")
    pos, x = table.column("pos").to_numpy(), table.column("y").to_numpy()
    own = table.column(hw.BKT).to_numpy() == table.column(hw.HOME).to_numpy()
    uid, mean = table.column("unique_id")[0].as_py(), table.column("mean")[0].as_py()
    orders, covlags = table.column("orders")[0].as_py(), table.column("covlags")[0].as_py()
    i, j, v = [], [], []
    at = np.flatnonzero(own & (pos >= orders + 2))
    if orders >= 0 and len(at):
        steps = np.diff(x, prepend=np.nan)
        back = np.stack([steps[at - k] for k in range(1, orders + 1)], axis=1) if orders else np.zeros((len(at), 0))
        rows = np.column_stack([np.ones(len(at)), x[at - 1] - mean, back, steps[at]])
        up = np.triu_indices(rows.shape[1])
        i += up[0].tolist()
        j += up[1].tolist()
        v += (rows.T @ rows)[up].tolist()
    dev = x - mean
    for lag in range(0, covlags + 1):
        at = np.flatnonzero(own & (pos > lag))
        i.append(_LAGS)
        j.append(lag)
        v.append(float(dev[at] @ dev[at - lag]))
    early = np.flatnonzero(own & (pos <= orders + 2))
    i += [_FIRST] * len(early)
    j += pos[early].tolist()
    v += dev[early].tolist()
    return pa.table({"unique_id": pa.array([uid] * len(i), pa.string()), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(v, pa.float64())})


def adf_from_products(g: np.ndarray, first: np.ndarray) -> tuple[float, int]:
    """Statistic and lag order from the summed products.

    ``g``: products of (constant, level, steps 1..P back, step), upper triangle filled; ``first``: the first
    P + 2 deviations, for the rows that orders below P have more than the common sample.
    """
    g = np.triu(g) + np.triu(g, 1).T
    k = len(g) - 1
    size = np.sqrt(np.diag(g))
    if not (size > 0).all():
        raise ValueError("a regression column is constant")
    scaled = g / np.outer(size, size)
    root = np.linalg.cholesky(scaled[:k, :k])
    part = np.linalg.solve(root, scaled[:k, k])
    nobs, regs = g[0, 0], np.arange(2, k + 1)
    ssr = g[k, k] * (1.0 - np.cumsum(part ** 2)[1:])
    lag = int(np.argmin(nobs * np.log(ssr / nobs) + 2.0 * regs))
    m = lag + 2
    part_of = np.r_[0:m, k]
    a, count = g[np.ix_(part_of, part_of)], nobs
    steps = np.diff(first)
    for t in range(lag, k - 2):                          # rows before the common sample
        row = np.r_[1.0, first[t], steps[t - lag:t][::-1], steps[t]]
        a, count = a + np.outer(row, row), count + 1
    inverse = np.linalg.inv(a[:m, :m] / np.outer(s := np.sqrt(np.diag(a)[:m]), s)) / np.outer(s, s)
    beta = inverse @ a[:m, m]
    sigma2 = (a[m, m] - beta @ a[:m, m]) / (count - m)
    return float(beta[1] / np.sqrt(sigma2 * inverse[1, 1])), lag


def _solve(table: pa.Table) -> pa.Table:
    """One row a series: the ADF statistic and lag, and the bandwidth of KPSS."""
    i, j, v = (table.column(c).to_numpy() for c in ("i", "j", "v"))
    stat, lag, p = None, None, None
    cells = i >= 0
    if cells.any():
        g = np.zeros((int(j[cells].max()) + 1,) * 2)
        g[i[cells], j[cells]] = v[cells]
        order = np.argsort(j[i == _FIRST])
        try:
            stat, lag = adf_from_products(g, v[i == _FIRST][order])
            if not np.isfinite(stat):
                raise ValueError("no variance left")
            p = SM.adf_pvalue(stat)
        except (ValueError, np.linalg.LinAlgError):
            stat, lag, p = None, None, None
    lags = np.zeros(int(j[i == _LAGS].max()) + 1)
    lags[j[i == _LAGS]] = v[i == _LAGS]
    return pa.table({"unique_id": table.column("unique_id").slice(0, 1), "adf_statistic": pa.array([stat], pa.float64()), "adf_pvalue": pa.array([p], pa.float64()),
                     "adf_usedlag": pa.array([lag], pa.int32()), "e0": pa.array([lags[0]]), "c1": pa.array([lags[1:].sum()]), "c2": pa.array([(np.arange(1, len(lags)) * lags[1:]).sum()])})


def _running_sums(values: DataFrame, bucket: int) -> DataFrame:
    """``run``: sum of the deviations up to each row, inside buckets plus a carry over the buckets."""
    d = values.select("unique_id", "pos", (F.col("y") - F.col("mean")).alias("e")).withColumn("_b", hw.bucket_of(F.col("pos"), bucket))
    inside = F.sum("e").over(Window.partitionBy("unique_id", "_b").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    totals = d.groupBy("unique_id", "_b").agg(F.sum("e").alias("total"))
    before = F.coalesce(F.sum("total").over(Window.partitionBy("unique_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    carry = totals.select("unique_id", "_b", before.alias("carry"))
    return d.withColumn("inside", inside).join(carry, ["unique_id", "_b"]).select("unique_id", "pos", (F.col("inside") + F.col("carry")).alias("run"))


def kpss_pvalue(stat: Column) -> Column:
    """p-value by linear interpolation between the critical values; the ends are bounds."""
    table = list(zip(SM.KPSS_CRIT, SM.KPSS_P, strict=True))
    out = F.when(stat <= table[0][0], table[0][1])
    for (x0, p0), (x1, p1) in zip(table, table[1:], strict=False):
        out = out.when(stat <= x1, F.lit(p0) + (stat - x0) * ((p1 - p0) / (x1 - x0)))
    return F.when(stat.isNotNull(), out.otherwise(table[-1][1]))


def stationarity_tests(panel: DataFrame, max_points: int | None = None, bucket: int = BUCKET_STEPS) -> DataFrame:
    """D-9 / D-10 on the whole history of every series (the last ``max_points`` values if given).

    Returns ``unique_id, used_observations, adf_statistic, adf_pvalue, adf_usedlag, kpss_statistic, kpss_pvalue,
    kpss_lags``; a test that cannot be made (too few values, none that differ) has NULLs.
    """
    values = _values(panel, max_points)
    behind = values.agg(F.max(F.greatest("orders", "covlags"))).first()[0]
    cells = hw.with_halo(values, max(1, (behind or 0) + 1), bucket=bucket).groupBy("unique_id", hw.BKT).applyInArrow(_bucket_cells, _CELL)
    summed = cells.groupBy("unique_id", "i", "j").agg(F.sum("v").alias("v"))
    solved = summed.groupBy("unique_id").applyInArrow(_solve, "unique_id string, adf_statistic double, adf_pvalue double, adf_usedlag int, e0 double, c1 double, c2 double")
    facts = values.select("unique_id", "n").groupBy("unique_id").agg(F.first("n").alias("n"))
    n = F.col("n").cast("double")
    s0, s1 = (F.col("e0") + 2.0 * F.col("c1")) / n, 2.0 * F.col("c2") / n
    width = F.floor(F.lit(1.1447) * F.cbrt(F.pow(s1 / s0, F.lit(2.0))) * F.cbrt(n))
    series = materialize(solved.join(facts, "unique_id").withColumn("lags", F.when(F.col("e0") > 0, F.least(width, n - 1).cast("long"))))
    runs = _running_sums(values, bucket).join(series.select("unique_id", "n", "lags"), "unique_id")
    later = runs.select("unique_id", (F.col("pos") - F.col("lags") - 1).alias("pos"), F.col("run").alias("ahead"))
    pairs = runs.join(later.where("pos > 0"), ["unique_id", "pos"], "left")
    # sums of lags + 1 neighbours: between two running sums, or up to one of the first ones, or from one of the last ones on
    square = F.when(F.col("ahead").isNotNull(), F.pow(F.col("ahead") - F.col("run"), F.lit(2.0))).otherwise(F.pow("run", F.lit(2.0)))
    first = F.when(F.col("pos") <= F.col("lags") + 1, F.pow("run", F.lit(2.0))).otherwise(0.0)
    sums = pairs.where("lags IS NOT NULL").groupBy("unique_id").agg(F.sum(square + first).alias("around"), F.sum(F.pow("run", F.lit(2.0))).alias("runs"))
    told = series.join(sums, "unique_id", "left")
    kpss = F.try_divide(F.col("runs") / (n * n), F.col("around") / (F.col("lags") + 1) / n)
    told = told.withColumn("kpss_statistic", kpss)
    return told.select("unique_id", F.col("n").alias("used_observations"), "adf_statistic", "adf_pvalue", "adf_usedlag", "kpss_statistic",
                       kpss_pvalue(F.col("kpss_statistic")).alias("kpss_pvalue"), F.when(F.col("kpss_statistic").isNotNull(), F.col("lags").cast("int")).alias("kpss_lags"))
