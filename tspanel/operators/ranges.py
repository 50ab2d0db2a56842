"""Aggregates of one value column over many position ranges per series.

Backtest windows need statistics of the training part ``[lo, hi]`` of every
(series, window); those ranges overlap almost completely. Joining rows to
ranges would copy the history once per window. Instead the range borders cut
each series into at most ``2W + 1`` segments, every row is aggregated once
into its segment (map-side partial aggregation), and each range sums the few
segment summaries it covers. Only additive / mergeable summaries are used:
count, sum, sum of squares, sum of absolute values, min, max.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_moments(values: DataFrame, ranges: DataFrame, value: str = "v",
                  keys: tuple[str, ...] = ("window",)) -> DataFrame:
    """Moments of ``value`` over the inclusive ranges ``[lo, hi]``.

    ``values``: ``unique_id, pos, <value>`` (NULL values are skipped).
    ``ranges``: ``unique_id, *keys, lo, hi``.
    Returns ``unique_id, *keys, cnt, s, ss, sa, mn, mx``.
    """
    borders = (ranges.select("unique_id", F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("b"))
                     .groupBy("unique_id").agg(F.array_sort(F.collect_set("b")).alias("_bs")))
    v = F.col(value)
    seg = (values.join(borders, "unique_id")
                 .withColumn("_seg", F.size(F.filter("_bs", lambda x: x <= F.col("pos"))))
                 .filter((F.col("_seg") > 0) & (F.col("_seg") < F.size("_bs")))
                 .groupBy("unique_id", "_seg")
                 .agg(F.first(F.element_at("_bs", F.col("_seg"))).alias("_lo"),
                      (F.first(F.element_at("_bs", F.col("_seg") + 1)) - 1).alias("_hi"),
                      F.count(v).alias("cnt"), F.sum(v).alias("s"), F.sum(v * v).alias("ss"),
                      F.sum(F.abs(v)).alias("sa"), F.min(v).alias("mn"), F.max(v).alias("mx")))
    joined = ranges.join(seg, "unique_id").filter((F.col("_lo") >= F.col("lo")) & (F.col("_hi") <= F.col("hi")))
    out = joined.groupBy("unique_id", *keys).agg(
        F.sum("cnt").alias("cnt"), F.sum("s").alias("s"), F.sum("ss").alias("ss"),
        F.sum("sa").alias("sa"), F.min("mn").alias("mn"), F.max("mx").alias("mx"))
    # Ranges that cover no row still get a row (count 0).
    return ranges.select("unique_id", *keys).join(out, ["unique_id", *keys], "left").select(
        "unique_id", *keys, F.coalesce("cnt", F.lit(0)).alias("cnt"), "s", "ss", "sa", "mn", "mx")


def pop_std(cnt: str = "cnt", s: str = "s", ss: str = "ss"):
    """Population standard deviation from count / sum / sum of squares."""
    n = F.col(cnt).cast("double")
    mean = F.try_divide(F.col(s), n)
    var = F.greatest(F.try_divide(F.col(ss), n) - mean * mean, F.lit(0.0))
    return F.when(F.col(cnt) > 0, F.sqrt(var))


def range_sums(values: DataFrame, ranges: DataFrame, value_cols: list[str],
               keys: tuple[str, ...] = ("window",)) -> DataFrame:
    """Like ``range_moments`` for several value columns in one pass: returns
    ``unique_id, *keys, n_<v>, s_<v>, ss_<v>, sa_<v>`` for each value column:
    count, sum and sum of squares of what is left after taking the series' mean
    away (``pop_std`` is the same), and sum of absolute values.
    Ranges of different families can share the table (add a family key)."""
    borders = (ranges.select("unique_id", F.explode(F.array(F.col("lo"), F.col("hi") + 1)).alias("b"))
                     .groupBy("unique_id").agg(F.array_sort(F.collect_set("b")).alias("_bs")))
    aggs = []
    for v in value_cols:
        c = F.col(v)
        aggs += [F.count(c).alias(f"n_{v}"), F.avg(c).alias(f"m_{v}"), F.var_pop(c).alias(f"q_{v}"),
                 F.sum(F.abs(c)).alias(f"sa_{v}")]
    seg = (values.join(borders, "unique_id")
                 .withColumn("_seg", F.size(F.filter("_bs", lambda x: x <= F.col("pos"))))
                 .filter((F.col("_seg") > 0) & (F.col("_seg") < F.size("_bs")))
                 .withColumn("_lo", F.element_at("_bs", F.col("_seg")))
                 .withColumn("_hi", F.element_at("_bs", F.col("_seg") + 1) - 1)
                 .groupBy("unique_id", "_lo", "_hi").agg(*aggs))
    # moments about the series' mean: raw squares would lose all digits of a small spread about a large mean
    series = Window.partitionBy("unique_id")
    for v in value_cols:
        n, m = F.col(f"n_{v}"), F.col(f"m_{v}")
        away = m - F.try_divide(F.sum(n * m).over(series), F.sum(F.when(n > 0, n)).over(series))
        seg = seg.withColumn(f"s_{v}", n * away).withColumn(f"ss_{v}", n * (F.col(f"q_{v}") + away * away))
    joined = ranges.join(seg, "unique_id").filter((F.col("_lo") >= F.col("lo")) & (F.col("_hi") <= F.col("hi")))
    outs = []
    for v in value_cols:
        outs += [F.sum(f"n_{v}").alias(f"n_{v}"), F.sum(f"s_{v}").alias(f"s_{v}"),
                 F.sum(f"ss_{v}").alias(f"ss_{v}"), F.sum(f"sa_{v}").alias(f"sa_{v}")]
    out = joined.groupBy("unique_id", *keys).agg(*outs)
    return ranges.select("unique_id", *keys).join(out, ["unique_id", *keys], "left")
