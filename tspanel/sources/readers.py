"""Readers and sinks (S-1..S-8).

Files are read with an explicit all-string schema and typed with ``try_cast``
/ ``try_to_timestamp`` (ANSI mode would make a plain cast throw). Ingest order,
needed for "keep the first duplicate", is ``monotonically_increasing_id``,
which follows file split and row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tspanel.operators.prepare import (RAW_NA_TOKENS, dedupe_keep_first, na_tokens_to_null, regularize,
                                       to_number, to_timestamp)
from tspanel.schema import METRIC_COLUMNS, require_columns

RAW_DATE_FORMAT = "dd/MM/yyyy HH:mm:ss"
HOUSEHOLD_TARGET = "Global_active_power"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on the file system that its scheme names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _header(spark: SparkSession, path: str, sep: str) -> list[str]:
    first = spark.read.option("sep", sep).option("header", "false").csv(path).limit(1).collect()
    return [str(v) for v in first[0]] if first else []


def read_text_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header, every column as STRING, plus ingest order ``_row``."""
    cols = _header(spark, path, sep)
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
    df = spark.read.option("sep", sep).option("header", "true").schema(schema).csv(path)
    return df.withColumn("_row", F.monotonically_increasing_id())


def parse_simple_series(df: DataFrame, date_col: str = "ds", target_col: str = "y",
                        order_col: str = "_row") -> DataFrame:
    """S-1 typing: keep the two columns, coerce, drop duplicate dates keeping
    the first (by ``order_col``)."""
    require_columns(df, [date_col, target_col])
    typed = df.select(to_timestamp(date_col).alias(date_col), to_number(target_col).alias(target_col), order_col)
    return dedupe_keep_first(typed, [date_col], order_col).drop(order_col)


def read_simple_series(spark: SparkSession, path: str, date_col: str = "ds", target_col: str = "y") -> DataFrame:
    """S-1: ``load_time_series``."""
    return parse_simple_series(read_text_table(spark, path), date_col, target_col)


def parse_raw_sensor(df: DataFrame, date_col: str = "Date", time_col: str = "Time",
                     order_col: str = "_row", tokens: Sequence[str] = RAW_NA_TOKENS,
                     fmt: str = RAW_DATE_FORMAT) -> DataFrame:
    """S-2 / S-3 / P-1 / X-6: text table → ``ds`` + numeric columns.

    NA tokens become NULL, ``Date`` and ``Time`` are joined and parsed
    day-first (bad input → NULL), every other column becomes DOUBLE, then one
    row per ``ds`` is kept (the first by ``order_col``).
    """
    require_columns(df, [date_col, time_col])
    numeric = [c for c in df.columns if c not in (date_col, time_col, order_col, "ds")]
    ds = to_timestamp(F.concat_ws(" ", F.col(date_col), F.col(time_col)), fmt)
    typed = df.select(ds.alias("ds"), *[to_number(na_tokens_to_null(F.col(f"`{c}`"), tokens)).alias(c) for c in numeric],
                      F.col(order_col))
    return dedupe_keep_first(typed, ["ds"], order_col).drop(order_col)


def read_raw_sensor(spark: SparkSession, path: str) -> DataFrame:
    """S-2: ``;``-separated raw sensor file."""
    df = read_text_table(spark, path, sep=";")
    require_columns(df, ["Date", "Time", HOUSEHOLD_TARGET])
    return parse_raw_sensor(df)


def load_prepared(spark: SparkSession, path: str, fmt: str = "parquet", drop_missing: bool = False) -> DataFrame:
    """S-4 / S-5: prepared ``unique_id, ds, y`` with type coercion (a stored
    grid position ``pos`` is kept, so no per-series join is needed later)."""
    if fmt == "csv":
        df = read_text_table(spark, path).drop("_row")
    else:
        df = spark.read.format(fmt).load(path)
    require_columns(df, ["unique_id", "ds", "y"], "prepared series")
    cols = [F.col("unique_id").cast("string"), to_timestamp("ds").alias("ds"), to_number("y").alias("y")]
    if "pos" in df.columns:
        cols.append(F.col("pos").cast("long"))
    out = df.select(*cols)
    return out.dropna(subset=["ds", "y"]) if drop_missing else out


def read_metrics_table(spark: SparkSession, path: str, group: str, fmt: str = "csv") -> DataFrame:
    """S-6: optional metrics table; missing file or no ``model`` column → empty."""
    schema = "model string, " + ", ".join(f"{c} double" for c in METRIC_COLUMNS) + ", group string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = read_text_table(spark, path).drop("_row") if fmt == "csv" else spark.read.format(fmt).load(path)
    if "model" not in df.columns:
        return spark.createDataFrame([], schema)
    cols = [F.col("model").cast("string")]
    cols += [to_number(c).alias(c) if c in df.columns else F.lit(None).cast("double").alias(c) for c in METRIC_COLUMNS]
    return df.select(*cols, F.lit(group).alias("group"))


def load_or_prepare(spark: SparkSession, prepared_path: str | None = None, raw_path: str | None = None,
                    sample_path: str | None = None, step_seconds: int = 3600,
                    unique_id: str = "household_1") -> DataFrame:
    """S-7: prepared file → else prepare the raw file → else a sample file."""
    if prepared_path and path_exists(spark, prepared_path):
        return load_prepared(spark, prepared_path, "csv" if prepared_path.endswith(".csv") else "parquet")
    if raw_path and path_exists(spark, raw_path):
        from tspanel.plans.pipelines import prepare_dataset
        return prepare_dataset(read_raw_sensor(spark, raw_path), step_seconds=step_seconds,
                               unique_id=unique_id)["prepared"]
    if sample_path and path_exists(spark, sample_path):
        s = read_simple_series(spark, sample_path).withColumn("unique_id", F.lit("sample_series"))
        return regularize(s, step_seconds, fill="interpolate")
    raise FileNotFoundError("no prepared, raw or sample series found")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    """S-8: table sink (parquet by default; ``partitionBy`` for panels)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
