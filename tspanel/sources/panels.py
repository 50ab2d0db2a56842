"""Panels built from the driver tables (FIXTURES §2).

Each panel aggregates a fact table to ``unique_id, ds, y`` and regularises
it. Means and sums are taken over exact DECIMAL values and divided once as
DOUBLE, so the result does not depend on partitioning or summation order
(and is bit-identical in any SQL engine).

Each panel also has the equivalent SQL text (``panel_sql``) used as the
oracle's first CTEs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tspanel.operators.prepare import regularize


@dataclass(frozen=True)
class PanelDef:
    table: str
    id_col: str
    ts_col: str
    value_col: str
    agg: str            # mean | sum
    step_seconds: int
    season: int
    long_season: int


PANELS = {
    "H": PanelDef("events", "event_type", "ts", "value", "mean", 3600, 24, 168),
    "D": PanelDef("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "sum", 86400, 7, 28),
    "L": PanelDef("lineitem", "l_returnflag", "l_shipdate", "l_quantity", "mean", 86400, 7, 28),
    "U": PanelDef("events", "user_id", "ts", "value", "sum", 86400, 7, 28),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exact_sum(col: str):
    return F.sum(F.col(col).cast("decimal(18,2)")).cast("double")


def raw_panel(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Aggregated, not yet regular: ``unique_id, ds, y`` (non-empty cells only)."""
    p = PANELS[key]
    src = read_table(spark, sf_dir, p.table).select(p.id_col, p.ts_col, p.value_col)
    secs = F.unix_seconds(F.col(p.ts_col).cast("timestamp"))
    ds = F.timestamp_seconds(F.floor(secs / F.lit(p.step_seconds)) * F.lit(p.step_seconds))
    y = exact_sum(p.value_col)
    if p.agg == "mean":
        y = F.try_divide(y, F.count(p.value_col))
    return (src.groupBy(F.col(p.id_col).cast("string").alias("unique_id"), ds.alias("ds"))
               .agg(y.alias("y")))


def panel(spark: SparkSession, sf_dir: str, key: str = "H", fill: str = "time") -> DataFrame:
    """Regular panel ``unique_id, ds, y, pos`` (R-1 → R-3 → fill)."""
    p = PANELS[key]
    return regularize(raw_panel(spark, sf_dir, key), p.step_seconds, fill=fill)


# ---------------------------------------------------------------- SQL twins

def raw_panel_sql(key: str) -> str:
    p = PANELS[key]
    unit = "hour" if p.step_seconds == 3600 else "day"
    y = f"CAST(SUM(CAST({p.value_col} AS DECIMAL(18,2))) AS DOUBLE)"
    if p.agg == "mean":
        y = f"{y} / COUNT({p.value_col})"
    return (f"SELECT CAST({p.id_col} AS VARCHAR) AS unique_id, date_trunc('{unit}', {p.ts_col}) AS ds, {y} AS y "
            f"FROM {p.table} GROUP BY 1, 2")


def panel_sql(key: str = "H", fill: str = "time", name: str = "panel") -> str:
    """CTE list (without the leading WITH) defining ``<name>(unique_id, ds, y, pos)``."""
    p = PANELS[key]
    unit = "hour" if p.step_seconds == 3600 else "day"
    interval = "INTERVAL 1 HOUR" if unit == "hour" else "INTERVAL 1 DAY"
    fill_expr = {
        "none": "y",
        "ffill": "coalesce(y, pv, nv)",
        "time": "coalesce(y, (nv - pv) / (np_ - pp) * (pos - pp) + pv, pv, nv)",
        "interpolate": "coalesce(y, (nv - pv) / (np_ - pp) * (pos - pp) + pv, pv, nv)",
    }[fill]
    return f"""
{name}_agg AS ({raw_panel_sql(key)}),
{name}_bnd AS (SELECT unique_id, min(ds) AS mn, max(ds) AS mx FROM {name}_agg GROUP BY 1),
{name}_grid AS (
  SELECT unique_id, mn, unnest(generate_series(mn, mx, {interval})) AS ds FROM {name}_bnd),
{name}_dense AS (
  SELECT g.unique_id, g.ds, CAST(date_diff('{unit}', g.mn, g.ds) + 1 AS BIGINT) AS pos, a.y
  FROM {name}_grid g LEFT JOIN {name}_agg a ON a.unique_id = g.unique_id AND a.ds = g.ds),
{name}_nb AS (
  SELECT *,
    last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
    last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np_,
    first_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM {name}_dense),
{name} AS (SELECT unique_id, ds, {fill_expr} AS y, pos FROM {name}_nb)"""


# ---------------------------------------------------------------- raw sensor text table

def raw_sensor_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sensor layout (FIXTURES §2) derived from ``events``: day-first
    ``Date`` and minute ``Time`` text (so timestamps repeat), numbers as text
    with NA tokens, ingest order ``_row`` = ``event_id``."""
    ev = read_table(spark, sf_dir, "events")
    tok = (F.when(F.col("event_id") % 97 == 0, F.lit("?"))
            .when(F.col("event_id") % 89 == 0, F.lit(""))
            .when(F.col("event_id") % 83 == 0, F.lit("NA"))
            .otherwise(F.col("value").cast("string")))
    return ev.select(
        F.date_format("ts", "dd/MM/yyyy").alias("Date"),
        F.date_format(F.date_trunc("minute", F.col("ts")), "HH:mm:ss").alias("Time"),
        tok.alias("Global_active_power"),
        F.col("user_id").cast("string").alias("Sub_metering_1"),
        F.col("event_id").alias("_row"))


RAW_SENSOR_SQL = """
raw_text AS (
  SELECT strftime(ts, '%d/%m/%Y') AS "Date", strftime(date_trunc('minute', ts), '%H:%M:%S') AS "Time",
         CASE WHEN event_id % 97 = 0 THEN '?' WHEN event_id % 89 = 0 THEN '' WHEN event_id % 83 = 0 THEN 'NA'
              ELSE CAST(value AS VARCHAR) END AS gap_txt,
         CAST(user_id AS VARCHAR) AS sm1_txt, event_id AS rn
  FROM events),
raw_typed AS (
  SELECT try_strptime("Date" || ' ' || "Time", '%d/%m/%Y %H:%M:%S') AS ds,
         TRY_CAST(CASE WHEN gap_txt IN ('?', '', 'NA', 'NaN', 'nan', 'null', 'None') THEN NULL ELSE gap_txt END AS DOUBLE) AS gap,
         TRY_CAST(CASE WHEN sm1_txt IN ('?', '', 'NA', 'NaN', 'nan', 'null', 'None') THEN NULL ELSE sm1_txt END AS DOUBLE) AS sm1,
         rn
  FROM raw_text),
raw AS (
  SELECT ds, CASE WHEN isnan(gap) THEN NULL ELSE gap END AS "Global_active_power",
         CASE WHEN isnan(sm1) THEN NULL ELSE sm1 END AS "Sub_metering_1"
  FROM raw_typed QUALIFY row_number() OVER (PARTITION BY ds ORDER BY rn) = 1)"""


_PREPARED: dict[tuple, DataFrame] = {}


def prepared_panel(spark: SparkSession, sf_dir: str, key: str = "H", fill: str = "time") -> DataFrame:
    """The regular panel written once per application as a reliable checkpoint
    (in ``spark.checkpoint.dir``), the counterpart of the prepared-series table
    every later stage reads. Cuts the lineage of the grid / fill plan."""
    from tspanel.session import ensure_checkpoint_dir

    memo = (spark.sparkContext.applicationId, sf_dir, key, fill)
    if memo not in _PREPARED:
        ensure_checkpoint_dir(spark)
        _PREPARED[memo] = panel(spark, sf_dir, key, fill).checkpoint(eager=True)
    return _PREPARED[memo]
