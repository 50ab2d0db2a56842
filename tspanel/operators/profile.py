"""Profiling aggregates (A-1..A-7, A-12, A-13, S-9).

All statistics are per series (``unique_id``) and computed with aggregates that
combine map-side. Consecutive-timestamp gaps of a raw (irregular) series are
found in two levels — inside blocks of a fixed number of rows, then across the
small per-block table — so no window spans a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tspanel.config import HORIZON, WEEKLY_SEASON
from tspanel.operators.quantiles import exact_quantiles
from tspanel.session import materialize

# Percentiles of the descriptive table.
DESCRIBE_PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
#: Timestamps that one task compares with each other.
GAP_ROWS = 65_536


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def consecutive_gaps(df: DataFrame, rows: int = GAP_ROWS) -> DataFrame:
    """Gaps in seconds between each non-null timestamp and the previous one of
    its series, with the number of ``times`` (repeats of a timestamp give 0).
    Returns ``unique_id, gap, times``.

    Distinct timestamps are sorted across the cluster and numbered once; blocks
    of ``rows`` neighbours are compared inside, then the blocks' first and last
    timestamps with each other.
    """
    stamps = df.where(F.col("unique_id").isNotNull() & F.col("ds").isNotNull()).groupBy("unique_id", "ds").agg(F.count(F.lit(1)).alias("_c"))
    placed = stamps.repartitionByRange("unique_id", "ds").sortWithinPartitions("unique_id", "ds").withColumn("_at", F.monotonically_increasing_id())
    # ids: the partition's number above 33 bits of the row's; blocks never span partitions
    block = F.shiftright("_at", 33) * F.lit(1 << 33) + F.floor(F.col("_at").bitwiseAND((1 << 33) - 1) / rows).cast("long")
    d = materialize(placed).withColumn("_block", block)
    w = Window.partitionBy("unique_id", "_block").orderBy("_at")
    inner = d.withColumn("gap", (_micros("ds") - F.lag(_micros("ds")).over(w)) / F.lit(1e6)).where(F.col("gap").isNotNull())
    ends = d.groupBy("unique_id", "_block").agg(F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    wb = Window.partitionBy("unique_id").orderBy("_block")
    cross = (ends.withColumn("_prev", F.lag("_last").over(wb)).filter(F.col("_prev").isNotNull())
                 .select("unique_id", ((_micros("_first") - _micros("_prev")) / F.lit(1e6)).alias("gap"), F.lit(1).cast("long").alias("times")))
    repeats = d.where("_c > 1").select("unique_id", F.lit(0.0).alias("gap"), (F.col("_c") - 1).alias("times"))
    return inner.select("unique_id", "gap", F.lit(1).cast("long").alias("times")).unionByName(cross).unionByName(repeats)


def step_stats(df: DataFrame, rows: int = GAP_ROWS) -> DataFrame:
    """A-2: most common (smallest on ties), min and max gap in seconds, plus the
    number of zero gaps (= repeated non-null timestamps)."""
    counts = consecutive_gaps(df, rows).groupBy("unique_id", "gap").agg(F.sum("times").alias("_c"))
    mode = counts.groupBy("unique_id").agg(
        F.max_by("gap", F.struct(F.col("_c"), -F.col("gap"))).alias("most_common_step"),
        F.min("gap").alias("min_step"), F.max("gap").alias("max_step"),
        F.coalesce(F.sum(F.when(F.col("gap") == 0, F.col("_c"))), F.lit(0)).alias("_zero_gaps"))
    return mode


def quality_report(df: DataFrame, target: str = "y", rows: int = GAP_ROWS) -> DataFrame:
    """A-1 (+A-2): one row per series.

    rows, columns, date_min, date_max, missing_dates, duplicate_dates (every
    repeat counts, NULL dates equal), step statistics, missing_target,
    target_min/max/mean/median.
    """
    y = F.col(target)
    base = df.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ds").alias("date_min"), F.max("ds").alias("date_max"),
        F.count_if(F.col("ds").isNull()).alias("missing_dates"),
        F.count_if(y.isNull()).alias("missing_target"),
        F.min(y).alias("target_min"), F.max(y).alias("target_max"), F.avg(y).alias("target_mean"))
    med = exact_quantiles(df, ["unique_id"], target, [0.5], out="_q").withColumnRenamed("_q_0", "target_median")
    base = base.join(med, "unique_id", "left").withColumn("columns", F.lit(len(df.columns)).cast("bigint"))
    out = base.join(step_stats(df, rows), "unique_id", "left")
    # every repeat counts; NULL timestamps are equal to each other (pandas ``duplicated``)
    dups = (F.coalesce(F.col("_zero_gaps"), F.lit(0))
            + F.when(F.col("missing_dates") > 0, F.col("missing_dates") - 1).otherwise(F.lit(0)))
    return out.withColumn("duplicate_dates", dups.cast("bigint")).drop("_zero_gaps")


def missing_values_table(df: DataFrame) -> DataFrame:
    """A-3: per column missing count and share and type, sorted by share desc."""
    aggs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = c.isNull() | F.isnan(c) if f.dataType.typeName() in ("double", "float") else c.isNull()
        aggs.append(F.count_if(miss).alias(f.name))
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *aggs)
    long = counts.unpivot(["_n"], [f.name for f in df.schema.fields], "column", "missing_count")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, dtype string")
    out = (long.join(F.broadcast(types), "column")
               .withColumn("missing_share", F.try_divide(F.col("missing_count"), F.col("_n")))
               .select("column", "missing_count", "missing_share", "dtype"))
    return out.orderBy(F.col("missing_share").desc(), F.col("column"))


def describe(df: DataFrame, target: str = "y", percentiles: Sequence[float] = DESCRIBE_PERCENTILES) -> DataFrame:
    """A-4..A-6: count, mean, std (n-1), min, percentiles (linear interpolation),
    max, missing/zero count and share, bias-corrected skew and excess kurtosis."""
    y = F.col(target)
    out = df.groupBy("unique_id").agg(
        F.count(y).alias("count"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"), F.max(y).alias("max"),
        F.count_if(y.isNull()).alias("missing_count"), F.avg(y.isNull().cast("double")).alias("missing_share"),
        F.count_if(y == 0).alias("zero_count"), F.avg(F.coalesce((y == 0).cast("double"), F.lit(0.0))).alias("zero_share"),
        F.skewness(y).alias("_g1"), F.kurtosis(y).alias("_g2"))
    n = F.col("count").cast("double")
    flat = F.col("min") == F.col("max")      # no spread: 0, as the usual data frame libraries have it
    skew = F.when(n > 2, F.when(flat, 0.0).otherwise(F.col("_g1") * F.sqrt(n * (n - 1)) / (n - 2)))
    kurt = F.when(n > 3, F.when(flat, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("_g2") + 6)))
    q = exact_quantiles(df, ["unique_id"], target, percentiles, out="_q")
    q = q.select("unique_id", *[F.col(f"_q_{i}").alias(f"p{int(round(p * 100)):02d}") for i, p in enumerate(percentiles)])
    out = out.join(q, "unique_id", "left")
    return out.withColumn("skew", skew).withColumn("kurtosis", kurt).drop("_g1", "_g2")


def seasonal_profiles(df: DataFrame, target: str = "y") -> DataFrame:
    """A-7: mean by hour, weekday (Monday = 0) and month in one pass with
    grouping sets. Returns ``unique_id, profile, key, y``."""
    d = df.filter(F.col("ds").isNotNull()).select("unique_id", F.hour("ds").alias("hour"), F.weekday("ds").alias("day_of_week"),
                  F.month("ds").alias("month"), F.col(target).alias("_y"))
    g = d.groupingSets([["unique_id", "hour"], ["unique_id", "day_of_week"], ["unique_id", "month"]],
                       "unique_id", "hour", "day_of_week", "month").agg(F.avg("_y").alias("y"))
    profile = (F.when(F.col("hour").isNotNull(), F.lit("hourly"))
                .when(F.col("day_of_week").isNotNull(), F.lit("weekly")).otherwise(F.lit("monthly")))
    key = F.coalesce("hour", "day_of_week", "month").cast("bigint")
    return g.select("unique_id", profile.alias("profile"), key.alias("key"), "y")


def validate_series(df: DataFrame, step_seconds: int = 3600, min_length: int = WEEKLY_SEASON + HORIZON,
                    required: Sequence[str] = ("unique_id", "ds", "y"),
                    rows: int = GAP_ROWS) -> DataFrame:
    """A-12: six checks per series → ``unique_id, test, status, observed``."""
    has_cols = set(required).issubset(df.columns)
    kinds = {"unique_id": "string", "ds": "timestamp", "y": "double"}
    df = df.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in df.columns})
    gaps = consecutive_gaps(df, rows)
    irregular = gaps.groupBy("unique_id").agg(F.coalesce(F.sum(F.when(F.col("gap") != F.lit(float(step_seconds)), F.col("times"))), F.lit(0)).alias("irregular"),
                                              F.coalesce(F.sum(F.when(F.col("gap") == 0, F.col("times"))), F.lit(0)).alias("_zero"))
    stats = df.groupBy("unique_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ds").isNull()).alias("_nulls"),
        F.count_if(F.col("y").isNull()).alias("missing"),
        F.avg(F.coalesce((F.col("y") < 0).cast("double"), F.lit(0.0))).alias("neg_share"))
    s = (stats.join(irregular, "unique_id", "left")
              .withColumn("irregular", F.coalesce("irregular", F.lit(0)))
              .withColumn("dups", F.coalesce("_zero", F.lit(0))
                          + F.when(F.col("_nulls") > 0, F.col("_nulls") - 1).otherwise(F.lit(0))))

    def row(test: str, status: Column, observed: Column) -> Column:
        return F.struct(F.lit(test).alias("test"), status.alias("status"), observed.cast("double").alias("observed"))

    def pf(ok: Column, bad: str = "fail") -> Column:
        return F.when(ok, F.lit("pass")).otherwise(F.lit(bad))

    tests = F.array(
        row("required_columns", F.lit("pass" if has_cols else "fail"), F.lit(1.0 if has_cols else 0.0)),
        row("no_duplicate_timestamps", pf(F.col("dups") == 0), F.col("dups")),
        row("no_missing_target", pf(F.col("missing") == 0), F.col("missing")),
        row("regular_frequency", F.when(F.col("n") > 1, pf(F.col("irregular") == 0, "warn")).otherwise(F.lit("fail")),
            F.col("irregular")),
        row("enough_history", pf(F.col("n") >= min_length), F.col("n")),
        row("non_negative_target", pf(F.col("neg_share") == 0, "warn"), F.col("neg_share")),
    )
    return s.select("unique_id", F.explode(tests).alias("t")).select("unique_id", "t.test", "t.status", "t.observed")


def window_numbers(cutoffs: DataFrame) -> DataFrame:
    """A-13: distinct cutoff timestamps of each series → window number 1..k
    (oldest first). Ranked per series, so each window partition holds only
    that series' few cutoffs (never one global ordering)."""
    d = cutoffs.select("unique_id", "cutoff").distinct()
    return d.withColumn("window", F.dense_rank().over(Window.partitionBy("unique_id").orderBy("cutoff")))


def flatten_report(wide: DataFrame, block: str | Column, id_cols: Sequence[str] = ("unique_id",)) -> DataFrame:
    """S-9: one-row-per-series report → long ``block, metric, value`` with the
    value as text (numbers ``%.6f``, timestamps ``yyyy-MM-dd HH:mm:ss``)."""
    cols = []
    for f in wide.schema.fields:
        if f.name in id_cols:
            continue
        c = F.col(f"`{f.name}`")
        t = f.dataType.typeName()
        if t in ("double", "float"):
            c = F.format_string("%.6f", c)
        elif t.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    blk = F.lit(block) if isinstance(block, str) else block
    text = wide.select(*id_cols, *cols).withColumn("block", blk)
    names = [f.name for f in wide.schema.fields if f.name not in id_cols]
    return text.unpivot([*id_cols, "block"], names, "metric", "value")
