"""Typing, resampling, regular grid and gap filling (P-1..P-6, R-1..R-7, W-0).

Every function takes and returns a DataFrame. A *regular panel* has the columns
``unique_id, ds, y, pos`` where ``pos`` is the 1-based grid position of ``ds``
inside its series; positions are computed by arithmetic from the series'
first timestamp, never by a whole-series sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tspanel.config import BUCKET_STEPS
from tspanel.operators.windowing import bucket_of
from tspanel.schema import require_columns
from tspanel.session import materialize

# Missing-value tokens of the raw sensor format, in reference order.
RAW_NA_TOKENS = ["?", "", "NA", "NaN", "nan", "null", "None"]

FILL_METHODS = ("interpolate", "time", "ffill", "none")

# Grid positions generated per chunk when the grid is exploded (two levels, so a
# long series is spread over many tasks instead of one generator).
GRID_CHUNK = 4096


# ---------------------------------------------------------------- scalars (P-1, S-3, P-7, P-8)

def na_tokens_to_null(c: Column | str, tokens: Sequence[str] = RAW_NA_TOKENS) -> Column:
    """S-3: any of the NA tokens (exact match) becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def nan_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def to_number(c: Column | str) -> Column:
    """P-1: text or number to DOUBLE; unparsable → NULL, NaN → NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return nan_to_null(c.cast("string").try_cast("double"))


def to_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """P-1 / X-6: parse text to TIMESTAMP; bad input → NULL."""
    c = F.col(c) if isinstance(c, str) else c
    if fmt is None:
        return c.cast("string").try_cast("timestamp")
    return F.try_to_timestamp(c.cast("string"), F.lit(fmt)).cast("timestamp")


def flag_or_false(c: Column) -> Column:
    """P-7: a NULL flag counts as False."""
    return F.coalesce(c, F.lit(False))


def zero_to_null(c: Column) -> Column:
    """P-8: zero divisor becomes NULL."""
    return F.nullif(c, F.lit(0.0))


# ---------------------------------------------------------------- projections

def to_panel(df: DataFrame, date_col: str = "ds", target_col: str = "y",
             unique_id: str = "series_1", id_col: str | None = None) -> DataFrame:
    """P-2: canonical ``unique_id, ds, y``; id from a constant or a column."""
    require_columns(df, [date_col, target_col] + ([id_col] if id_col else []))
    uid = F.col(id_col).cast("string") if id_col else F.lit(unique_id)
    return df.select(uid.alias("unique_id"), F.col(date_col).cast("timestamp").alias("ds"),
                     to_number(target_col).alias("y"))


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """P-3."""
    return df.dropna(subset=list(subset))


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """P-4: one row per key, the one with the smallest ``order_col``.

    An aggregate (``min_by`` of a struct) rather than a window, so it combines
    map-side and a repeated key never has to be sorted in one task.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    out = df.groupBy(*keys).agg(F.min_by(packed, F.col(order_col)).alias("_row"))
    return out.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


# ---------------------------------------------------------------- resampling (R-1, R-2)

def floor_to_step(ds: Column, step_seconds: int) -> Column:
    secs = F.unix_seconds(ds.cast("timestamp"))
    return F.timestamp_seconds(F.floor(secs / F.lit(step_seconds)) * F.lit(step_seconds))


def resample(df: DataFrame, step_seconds: int = 3600, agg: str = "mean", densify: bool = False) -> DataFrame:
    """R-1 / R-2: bucket ``ds`` down to the step and aggregate ``y``.

    ``mean`` skips NULLs; ``sum`` returns NULL when the bucket has no value
    (pandas ``min_count=1``). With ``densify`` every step between the first and
    last bucket is emitted (empty → NULL), as pandas ``resample`` does.
    """
    if agg not in ("mean", "sum"):
        raise ValueError("agg must be 'mean' or 'sum'")
    require_columns(df, ["unique_id", "ds", "y"])
    fn = F.avg if agg == "mean" else F.sum
    out = (df.filter(F.col("ds").isNotNull())
             .groupBy("unique_id", floor_to_step(F.col("ds"), step_seconds).alias("ds"))
             .agg(fn(nan_to_null("y")).alias("y")))
    if densify:
        return regularize(out, step_seconds, fill="none")
    return out


# ---------------------------------------------------------------- regular grid (R-3, W-0)

def series_bounds(df: DataFrame) -> DataFrame:
    return df.groupBy("unique_id").agg(F.min("ds").alias("_mn"), F.max("ds").alias("_mx"))


def grid(bounds: DataFrame, step_seconds: int, chunk: int = GRID_CHUNK) -> DataFrame:
    """Every step from ``_mn`` to ``_mx`` per series as ``unique_id, pos, ds``.

    Two-level explode: chunk starts first, repartitioned, then positions inside
    a chunk, so a very long series is generated by many tasks.
    """
    n = (F.floor((F.unix_seconds("_mx") - F.unix_seconds("_mn")) / F.lit(step_seconds)) + 1).cast("long")
    chunks = (bounds.withColumn("_n", n)
                    .withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.floor((F.col("_n") - 1) / F.lit(chunk)).cast("long"))))
                    .repartition("unique_id", "_c"))
    lo = F.col("_c") * F.lit(chunk) + F.lit(1)
    hi = F.least(F.col("_n"), (F.col("_c") + F.lit(1)) * F.lit(chunk))
    return (chunks.withColumn("pos", F.explode(F.sequence(lo, hi)))
                  .select("unique_id", "pos",
                          F.timestamp_seconds(F.unix_seconds("_mn") + (F.col("pos") - 1) * F.lit(step_seconds)).alias("ds")))


def regularize(df: DataFrame, step_seconds: int = 3600, fill: str = "interpolate",
               bucket: int = BUCKET_STEPS, order_col: str | None = None, keep_input: bool = True) -> DataFrame:
    """R-3 + R-4..R-7: regular grid from the first to the last timestamp.

    Rows without ``ds`` are dropped, duplicates keep the first (by ``order_col``
    or, lacking one, by the smallest ``y``), rows off the grid are dropped,
    missing slots are NULL and then filled with ``fill``. Returns
    ``unique_id, ds, y, pos``.

    The de-duplicated input feeds several branches (bounds, grid, on-grid
    rows); with ``keep_input`` it is written once to the checkpoint folder so
    the source table is scanned once, not once per branch.
    """
    if fill not in FILL_METHODS:
        raise ValueError(f"fill must be one of {FILL_METHODS}")
    require_columns(df, ["unique_id", "ds", "y"])
    rows = df.select("unique_id", F.col("ds").cast("timestamp").alias("ds"), nan_to_null("y").alias("y"),
                     *([F.col(order_col)] if order_col else []))
    rows = rows.filter(F.col("ds").isNotNull())
    if order_col:
        rows = dedupe_keep_first(rows, ["unique_id", "ds"], order_col).drop(order_col)
    else:
        rows = rows.groupBy("unique_id", "ds").agg(F.min("y").alias("y"))
    if keep_input:
        rows = materialize(rows)
    bounds = series_bounds(rows)
    off = F.unix_seconds("ds") - F.unix_seconds("_mn")
    on_grid = (rows.join(bounds, "unique_id")
                   .filter(off % F.lit(step_seconds) == 0)
                   .select("unique_id", (off / F.lit(step_seconds) + 1).cast("long").alias("pos"), "y"))
    dense = grid(bounds, step_seconds).join(on_grid, ["unique_id", "pos"], "left")
    dense = fill_gaps(dense, fill, bucket)
    return dense.select("unique_id", "ds", "y", "pos")


def with_position(df: DataFrame, step_seconds: int = 3600) -> DataFrame:
    """W-0 for a panel that is already regular but lacks ``pos``."""
    if "pos" in df.columns:
        return df
    bounds = df.groupBy("unique_id").agg(F.min("ds").alias("_mn"))
    off = F.unix_seconds(F.col("ds").cast("timestamp")) - F.unix_seconds("_mn")
    return df.join(bounds, "unique_id").withColumn("pos", (off / F.lit(step_seconds) + 1).cast("long")).drop("_mn")


# ---------------------------------------------------------------- gap filling (R-4..R-7, W-5)

def fill_gaps(df: DataFrame, method: str = "interpolate", bucket: int = BUCKET_STEPS) -> DataFrame:
    """Fill NULL ``y`` on a regular panel (needs ``pos``).

    interpolate / time: linear between the neighbouring known values (equal on a
    regular grid), leading / trailing gaps take the nearest known value.
    ffill: last known value, then next known value for a leading gap.

    Two levels so no window spans a whole series: nearest known value inside
    each bucket of positions, then a carry across the small per-bucket table.
    """
    if method not in FILL_METHODS:
        raise ValueError(f"fill must be one of {FILL_METHODS}")
    if method == "none":
        return df
    known = F.when(F.col("y").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("y").alias("v")))
    d = df.withColumn("_bkt", bucket_of(F.col("pos"), bucket))
    w = Window.partitionBy("unique_id", "_bkt").orderBy("pos")
    d = (d.withColumn("_prev", F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_next", F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))))
    kpos = F.when(F.col("y").isNotNull(), F.col("pos"))
    summary = d.groupBy("unique_id", "_bkt").agg(F.max_by(known, kpos).alias("_last"),
                                                 F.min_by(known, kpos).alias("_first"))
    wb = Window.partitionBy("unique_id").orderBy("_bkt")
    carry = summary.select(
        "unique_id", "_bkt",
        F.last("_last", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_cprev"),
        F.first("_first", ignorenulls=True).over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_cnext"))
    d = d.join(carry, ["unique_id", "_bkt"], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_cprev"))
    nxt = F.coalesce(F.col("_next"), F.col("_cnext"))
    if method == "ffill":
        filled = F.coalesce(F.col("y"), prev.getField("v"), nxt.getField("v"))
    else:
        slope = F.try_divide(nxt.getField("v") - prev.getField("v"), nxt.getField("p") - prev.getField("p"))
        interp = slope * (F.col("pos") - prev.getField("p")) + prev.getField("v")
        filled = F.coalesce(F.col("y"), interp, prev.getField("v"), nxt.getField("v"))
    return d.withColumn("y", filled).drop("_bkt", "_prev", "_next", "_cprev", "_cnext")


# ---------------------------------------------------------------- slicing (P-5, P-6)

def series_length(df: DataFrame) -> DataFrame:
    """Per-series ``n`` (last position) of a regular panel."""
    return df.groupBy("unique_id").agg(F.max("pos").alias("n"))


def row_numbers(df: DataFrame, out: str, bucket: int = BUCKET_STEPS) -> DataFrame:
    """``out`` = 1..n over the rows of every series in order of ``pos``, holes or not.

    Numbers within a bucket of positions plus the row counts of the buckets before, so
    no task sorts a whole series."""
    d = df.withColumn("_nb", F.floor((F.col("pos") - 1) / F.lit(bucket)))
    counts = d.groupBy("unique_id", "_nb").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("unique_id").orderBy("_nb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0))).drop("_c")
    own = F.row_number().over(Window.partitionBy("unique_id", "_nb").orderBy("pos"))
    return d.withColumn("_own", own).join(offsets, ["unique_id", "_nb"]).withColumn(out, F.col("_off") + F.col("_own")).drop("_nb", "_own", "_off")


def last_n(df: DataFrame, n_rows: int) -> DataFrame:
    """P-5: the last ``n_rows`` rows of every series, also where positions have holes."""
    numbered = row_numbers(df, "_i")
    counts = df.groupBy("unique_id").agg(F.count(F.lit(1)).alias("_rows"))
    return numbered.join(counts, "unique_id").filter(F.col("_i") > F.col("_rows") - F.lit(n_rows)).drop("_i", "_rows")


def train_test_split(df: DataFrame, test_size: int) -> tuple[DataFrame, DataFrame]:
    """P-6: ordered split; series with ``n <= test_size`` raise nothing but
    contribute no rows (``test_size <= 0`` raises)."""
    if test_size <= 0:
        raise ValueError("test_size must be positive")
    marked = (df.join(series_length(df), "unique_id")
                .filter(F.col("n") > F.lit(test_size))
                .withColumn("_test", F.col("pos") > F.col("n") - F.lit(test_size)))
    return (marked.filter(~F.col("_test")).drop("_test", "n"),
            marked.filter(F.col("_test")).drop("_test", "n"))
