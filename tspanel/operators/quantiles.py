"""Exact quantiles per group without holding a whole group in one task.

Spark's exact ``percentile`` aggregate merges a value→count map per group in
one task, so one very large group (a hot series) would not fit. Here all
probabilities of a group are searched together, by the same steps at any size:

1. ``n``, ``min`` and ``max`` per group; each probability needs the values at
   ranks ``k = floor(p·(n-1))`` and ``k+1`` (linear interpolation, the
   definition of Spark ``percentile`` / DuckDB ``quantile_cont``). The whole
   range with all ranks is the group's first interval.
2. A round counts the values of every interval in ``bins`` equal-width bins (a
   map-side combinable ``groupBy(...).count()``). Bins that hold a rank are the
   new intervals, with their ranks; they are written, so that no round repeats
   the ones before. Intervals of one value, or of at most ``cap`` values, are
   done; the others go into the next round.
3. The ≤ ``cap`` values of the intervals that are left are sorted and the ranks
   picked.

The values are written once. Rounds need a small driver-side check (are
intervals left?), like any iterative algorithm; the data never reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tspanel.session import materialize

CAP = 50_000
BINS = 4096


def _bin(bins: int) -> Column:
    """Equal-width bin of a value in its interval; halves, so that the width neither overflows nor vanishes unnoticed."""
    part = F.try_divide(F.col("_v") / 2 - F.col("_lo") / 2, F.col("_hi") / 2 - F.col("_lo") / 2)
    lost = part.isNull() & (F.col("_v") > F.col("_lo"))
    return F.when(lost, F.lit(bins - 1)).otherwise(F.least(F.floor(F.coalesce(part, F.lit(0.0)) * bins), F.lit(bins - 1))).cast("int")


def _narrow(d: DataFrame, active: DataFrame, keys: list[str], bins: int) -> DataFrame:
    """The bins of the intervals that hold a rank, as intervals: smallest and largest value, values, values below, ranks."""
    inside = d.join(active, keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
    hist = inside.groupBy(*keys, "_below", "_ranks", _bin(bins).alias("_b")).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    before = F.sum("_cnt").over(Window.partitionBy(*keys, "_below").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))     # ≤ bins rows
    hist = hist.withColumn("_from", F.col("_below") + F.coalesce(before, F.lit(0)))
    held = F.filter("_ranks", lambda r: (r >= F.col("_from")) & (r < F.col("_from") + F.col("_cnt")))
    return hist.select(*keys, "_lo", "_hi", "_cnt", F.col("_from").alias("_below"), held.alias("_ranks")).where(F.size("_ranks") > 0)


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    cap: int = CAP, bins: int = BINS, out: str = "q") -> DataFrame:
    """One row per group that has values: ``*keys`` and ``<out>_<i>`` for each
    probability (callers left-join, so groups without values get NULL)."""
    keys = list(keys)
    d = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    d = materialize(d.dropna(subset=keys))
    # the rank below and, between two values, the one above
    at = F.array(*[F.lit(float(p)) for p in probs])
    ranks = F.flatten(F.transform(at, lambda p: F.array(F.floor(p * (F.col("_cnt") - 1)), F.ceil(p * (F.col("_cnt") - 1))).cast("array<long>")))
    groups = d.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_cnt"))
    active = materialize(groups.select(*keys, "_lo", "_hi", "_cnt", F.lit(0).cast("long").alias("_below"), F.array_distinct(ranks).alias("_ranks")))
    sizes, done = active.select(*keys, F.col("_cnt").alias("_n")), None
    left = True
    while left:      # every round narrows an interval to one of its bins, so doubles run out of them
        found = materialize(_narrow(d, active, keys, bins))
        small = (F.col("_cnt") <= cap) | (F.col("_lo") == F.col("_hi"))
        done = found.where(small) if done is None else done.unionByName(found.where(small))
        active = found.where(~small)
        left = not active.isEmpty()
    # an interval of equal values is its own answer; others hold at most `cap` values
    flat = done.where(F.col("_lo") == F.col("_hi")).select(*keys, F.explode("_ranks").alias("_r"), F.col("_lo").alias("_x"))
    rest = done.where(F.col("_lo") < F.col("_hi"))
    held = (d.join(rest, keys).where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
             .groupBy(*keys, "_below", "_ranks").agg(F.array_sort(F.collect_list("_v")).alias("_a")))
    picked = held.select(*keys, "_below", "_a", F.explode("_ranks").alias("_r")).select(
        *keys, "_r", F.element_at("_a", (F.col("_r") - F.col("_below") + 1).cast("int")).alias("_x"))
    maps = picked.unionByName(flat).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_r", "_x"))).alias("_at"))
    told = sizes.join(maps, keys)
    cols = []
    for i, p in enumerate(probs):
        x0, x1 = (F.element_at("_at", edge.cast("long")) for edge in (F.floor(F.lit(float(p)) * (F.col("_n") - 1)), F.ceil(F.lit(float(p)) * (F.col("_n") - 1))))
        spot = F.lit(float(p)) * (F.col("_n") - 1)
        cols.append((x0 + (x1 - x0) * (spot - F.floor(spot))).alias(f"{out}_{i}"))
    return told.select(*keys, *cols)
