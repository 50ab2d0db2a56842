"""Queries: sources, typing, resampling, gap filling, profiling, validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tspanel.operators import prepare as P
from tspanel.operators import profile as A
from tspanel.plans import pipelines as PL
from tspanel.plans.registry import R, register, rnd
from tspanel.plans.util import rounded
from tspanel.sources.panels import RAW_SENSOR_SQL, panel, panel_sql, raw_panel, raw_panel_sql, raw_sensor_text
from tspanel.sources.readers import parse_raw_sensor


def _raw(spark, sf):
    return parse_raw_sensor(raw_sensor_text(spark, sf))


def _raw_series(spark, sf):
    return _raw(spark, sf).select(F.lit("household_1").alias("unique_id"), "ds",
                                  F.col("Global_active_power").alias("y"))


RAW_SERIES_SQL = RAW_SENSOR_SQL + """,
rs AS (SELECT 'household_1' AS unique_id, ds, "Global_active_power" AS y FROM raw)"""


# ---------------------------------------------------------------- S-2, S-3, P-1, P-4, X-6

@register("raw_sensor_parse", f"""
WITH {RAW_SENSOR_SQL}
SELECT ds, {R('Global_active_power Sub_metering_1')} FROM raw""")
def q_raw_parse(spark, sf):
    """Raw text → typed, NA tokens → NULL, first row per timestamp kept."""
    return rounded(_raw(spark, sf))


# ---------------------------------------------------------------- R-1 (+ densify), R-2

HOURLY_SQL = """
hourly_agg AS (SELECT unique_id, date_trunc('hour', ds) AS ds, avg(y) AS y FROM rs WHERE ds IS NOT NULL GROUP BY 1, 2),
hb AS (SELECT unique_id, min(ds) AS mn, max(ds) AS mx FROM hourly_agg GROUP BY 1),
hg AS (SELECT unique_id, mn, unnest(generate_series(mn, mx, INTERVAL 1 HOUR)) AS ds FROM hb),
hourly AS (SELECT g.unique_id, g.ds, CAST(date_diff('hour', g.mn, g.ds) + 1 AS BIGINT) AS pos, a.y
           FROM hg g LEFT JOIN hourly_agg a ON a.unique_id = g.unique_id AND a.ds = g.ds)"""


@register("resample_mean_dense", f"""
WITH {RAW_SERIES_SQL}, {HOURLY_SQL}
SELECT unique_id, ds, {rnd('y')} AS y, pos FROM hourly""")
def q_resample_mean(spark, sf):
    """R-1: hourly mean, every hour between first and last, empty → NULL."""
    return rounded(P.resample(_raw_series(spark, sf), 3600, "mean", densify=True))


@register("resample_sum_min_count", f"""
WITH {RAW_SERIES_SQL}
SELECT unique_id, date_trunc('hour', ds) AS ds, {rnd('sum(y)')} AS y FROM rs WHERE ds IS NOT NULL GROUP BY 1, 2""")
def q_resample_sum(spark, sf):
    """R-2: hourly sum; an hour whose values are all missing stays NULL."""
    return rounded(P.resample(_raw_series(spark, sf), 3600, "sum"))


# ---------------------------------------------------------------- R-4, R-6, R-7

@register("fill_interpolate", f"""
WITH {panel_sql('H', 'interpolate')}
SELECT unique_id, ds, {rnd('y')} AS y, pos FROM panel""")
def q_fill_interpolate(spark, sf):
    return rounded(panel(spark, sf, "H", fill="interpolate"))


@register("fill_ffill", f"""
WITH {panel_sql('H', 'ffill')}
SELECT unique_id, ds, {rnd('y')} AS y, pos FROM panel""")
def q_fill_ffill(spark, sf):
    return rounded(panel(spark, sf, "H", fill="ffill"))


@register("fill_none_daily", f"""
WITH {panel_sql('D', 'none')}
SELECT unique_id, ds, {rnd('y')} AS y, pos FROM panel""")
def q_fill_none(spark, sf):
    """R-7 on the daily orders panel: gaps stay NULL."""
    return rounded(panel(spark, sf, "D", fill="none"))


@register("regular_grid_daily_lineitem", f"""
WITH {panel_sql('L', 'time')}
SELECT unique_id, ds, {rnd('y')} AS y, pos FROM panel""")
def q_grid_lineitem(spark, sf):
    return rounded(panel(spark, sf, "L", fill="time"))


# ---------------------------------------------------------------- P-5, P-6

@register("last_n_rows", f"""
WITH {panel_sql('H')}
SELECT p.unique_id, p.ds, {rnd('p.y')} AS y, p.pos FROM panel p
JOIN (SELECT unique_id, max(pos) AS n FROM panel GROUP BY 1) l USING (unique_id)
WHERE p.pos > l.n - 48""")
def q_last_n(spark, sf):
    """P-5: last 48 positions per series."""
    return rounded(P.last_n(panel(spark, sf, "H"), 48))


@register("train_test_split", f"""
WITH {panel_sql('H')}
SELECT p.unique_id, p.ds, {rnd('p.y')} AS y, p.pos > l.n - 72 AS is_test FROM panel p
JOIN (SELECT unique_id, max(pos) AS n FROM panel GROUP BY 1) l USING (unique_id)
WHERE l.n > 72""")
def q_split(spark, sf):
    """P-6: ordered split, last 72 positions are the test part."""
    train, test = P.train_test_split(panel(spark, sf, "H"), 72)
    out = (train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True))))
    return rounded(out.select("unique_id", "ds", "y", "is_test"))


# ---------------------------------------------------------------- A-1, A-2

QUALITY_SQL = """
q_gaps AS (SELECT unique_id, (epoch_us(ds) - epoch_us(lag(ds) OVER (PARTITION BY unique_id ORDER BY ds))) / 1e6 AS gap
           FROM {src} WHERE ds IS NOT NULL),
q_gc AS (SELECT unique_id, gap, count(*) AS c FROM q_gaps WHERE gap IS NOT NULL GROUP BY 1, 2),
q_steps AS (SELECT unique_id, first(gap ORDER BY c DESC, gap ASC) AS most_common_step, min(gap) AS min_step,
                   max(gap) AS max_step FROM q_gc GROUP BY 1),
q_base AS (SELECT unique_id, CAST(count(*) AS BIGINT) AS rows, min(ds) AS date_min, max(ds) AS date_max,
                  CAST(count(*) FILTER (WHERE ds IS NULL) AS BIGINT) AS missing_dates,
                  CAST(count(*) - count(DISTINCT ds) - CASE WHEN count(*) FILTER (WHERE ds IS NULL) > 0 THEN 1 ELSE 0 END AS BIGINT) AS duplicate_dates,
                  CAST(count(*) FILTER (WHERE y IS NULL) AS BIGINT) AS missing_target,
                  min(y) AS target_min, max(y) AS target_max, avg(y) AS target_mean,
                  quantile_cont(y, 0.5) AS target_median
           FROM {src} GROUP BY 1),
quality AS (SELECT b.*, CAST({ncols} AS BIGINT) AS columns, s.most_common_step, s.min_step, s.max_step
            FROM q_base b LEFT JOIN q_steps s USING (unique_id))"""


@register("quality_report_raw", f"""
WITH {RAW_SERIES_SQL}, {QUALITY_SQL.format(src='rs', ncols=3)}
SELECT unique_id, rows, date_min, date_max, missing_dates, duplicate_dates, missing_target,
       {R('target_min target_max target_mean target_median most_common_step min_step max_step')}, columns
FROM quality""")
def q_quality_raw(spark, sf):
    return rounded(A.quality_report(_raw_series(spark, sf)))


@register("quality_report_panel", f"""
WITH {panel_sql('H')}, {QUALITY_SQL.format(src='panel', ncols=4)}
SELECT unique_id, rows, date_min, date_max, missing_dates, duplicate_dates, missing_target,
       {R('target_min target_max target_mean target_median most_common_step min_step max_step')}, columns
FROM quality""")
def q_quality_panel(spark, sf):
    return rounded(A.quality_report(panel(spark, sf, "H")))


@register("quality_report_unaggregated", f"""
WITH agg AS (SELECT event_type AS unique_id, date_trunc('hour', ts) AS ds, value AS y FROM events),
{QUALITY_SQL.format(src='agg', ncols=3)}
SELECT unique_id, rows, date_min, date_max, missing_dates, duplicate_dates, missing_target,
       {R('target_min target_max target_mean target_median most_common_step min_step max_step')}, columns
FROM quality""")
def q_quality_dups(spark, sf):
    """A-1 on hour-truncated events: many duplicate timestamps and zero gaps."""
    ev = spark.read.parquet(f"{sf}/events.parquet")
    d = ev.select(F.col("event_type").alias("unique_id"), F.date_trunc("hour", "ts").alias("ds"), F.col("value").alias("y"))
    return rounded(A.quality_report(d))


# ---------------------------------------------------------------- S-9, PIPE-1

QUALITY_LONG_SQL = """
{name}_long AS (
  SELECT '{block}' AS block, metric, value FROM (
    SELECT CAST(rows AS VARCHAR) AS rows, strftime(date_min, '%Y-%m-%d %H:%M:%S') AS date_min,
           strftime(date_max, '%Y-%m-%d %H:%M:%S') AS date_max, CAST(missing_dates AS VARCHAR) AS missing_dates,
           CAST(duplicate_dates AS VARCHAR) AS duplicate_dates, CAST(missing_target AS VARCHAR) AS missing_target,
           printf('%.6f', target_min) AS target_min, printf('%.6f', target_max) AS target_max,
           printf('%.6f', target_mean) AS target_mean, printf('%.6f', target_median) AS target_median,
           CAST(columns AS VARCHAR) AS columns, printf('%.6f', most_common_step) AS most_common_step,
           printf('%.6f', min_step) AS min_step, printf('%.6f', max_step) AS max_step
    FROM {name}) UNPIVOT INCLUDE NULLS (value FOR metric IN (rows, date_min, date_max, missing_dates, duplicate_dates,
      missing_target, target_min, target_max, target_mean, target_median, columns, most_common_step, min_step, max_step)))"""


def _quality_block(src: str, name: str, ncols: int) -> str:
    q = QUALITY_SQL.replace("q_gaps", f"{name}_gaps").replace("q_gc", f"{name}_gc").replace(
        "q_steps", f"{name}_steps").replace("q_base", f"{name}_base").replace("quality AS", f"{name} AS")
    return q.format(src=src, ncols=ncols)


@register("prepare_quality_blocks", f"""
WITH {RAW_SERIES_SQL}, {HOURLY_SQL},
hourly_q AS (SELECT unique_id, ds, y FROM hourly),
prep_nb AS (
  SELECT *,
    last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
    last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np_,
    first_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM hourly),
prepared AS (SELECT unique_id, ds, coalesce(y, (nv - pv) / (np_ - pp) * (pos - pp) + pv, pv, nv) AS y FROM prep_nb),
{_quality_block('rs', 'qraw', 3)},
{_quality_block('hourly_q', 'qhour', 3)},
{_quality_block('prepared', 'qprep', 3)},
{QUALITY_LONG_SQL.format(name='qraw', block='raw')},
{QUALITY_LONG_SQL.format(name='qhour', block='hourly_before_fill')},
{QUALITY_LONG_SQL.format(name='qprep', block='prepared')}
SELECT 'household_1' AS unique_id, block, metric, value FROM qraw_long
UNION ALL SELECT 'household_1', block, metric, value FROM qhour_long
UNION ALL SELECT 'household_1', block, metric, value FROM qprep_long""")
def q_prepare_quality(spark, sf):
    """PIPE-1 + S-9: the three quality blocks of the prepare stage, long form."""
    out = PL.prepare_dataset(_raw(spark, sf))
    return out["quality"].select("unique_id", "block", "metric", "value")


@register("prepare_series", f"""
WITH {RAW_SERIES_SQL}, {HOURLY_SQL},
prep_nb AS (
  SELECT *,
    last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
    last_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np_,
    first_value(y IGNORE NULLS) OVER (PARTITION BY unique_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM hourly)
SELECT unique_id, ds, {rnd('coalesce(y, (nv - pv) / (np_ - pp) * (pos - pp) + pv, pv, nv)')} AS y, pos FROM prep_nb""")
def q_prepare_series(spark, sf):
    """PIPE-1: raw sensor text → prepared hourly panel (time interpolation)."""
    return rounded(PL.prepare_dataset(_raw(spark, sf))["prepared"])


# ---------------------------------------------------------------- A-3

@register("missing_values_raw", f"""
WITH {RAW_SENSOR_SQL}
SELECT "column", CAST(missing_count AS BIGINT) AS missing_count, {rnd('missing_count / n')} AS missing_share, dtype FROM (
  SELECT 'ds' AS "column", count(*) FILTER (WHERE ds IS NULL) AS missing_count, count(*) AS n, 'timestamp' AS dtype FROM raw
  UNION ALL SELECT 'Global_active_power', count(*) FILTER (WHERE "Global_active_power" IS NULL), count(*), 'double' FROM raw
  UNION ALL SELECT 'Sub_metering_1', count(*) FILTER (WHERE "Sub_metering_1" IS NULL), count(*), 'double' FROM raw)""")
def q_missing(spark, sf):
    return rounded(A.missing_values_table(_raw(spark, sf)))


# ---------------------------------------------------------------- A-4, A-5, A-6

DESCRIBE_SELECT = """
SELECT unique_id, CAST(count(y) AS BIGINT) AS count, {r_mean} AS mean, {r_std} AS std, {r_min} AS min, {r_max} AS max,
       CAST(count(*) FILTER (WHERE y IS NULL) AS BIGINT) AS missing_count,
       {r_ms} AS missing_share,
       CAST(count(*) FILTER (WHERE y = 0) AS BIGINT) AS zero_count,
       {r_zs} AS zero_share,
       {r_p01} AS p01, {r_p05} AS p05, {r_p25} AS p25, {r_p50} AS p50, {r_p75} AS p75, {r_p95} AS p95, {r_p99} AS p99,
       {r_skew} AS skew, {r_kurt} AS kurtosis
FROM {src} GROUP BY 1"""


def _describe_sql(src: str) -> str:
    return DESCRIBE_SELECT.format(
        src=src, r_mean=rnd("avg(y)"), r_std=rnd("stddev_samp(y)"), r_min=rnd("min(y)"), r_max=rnd("max(y)"),
        r_ms=rnd("avg(CASE WHEN y IS NULL THEN 1.0 ELSE 0.0 END)"),
        r_zs=rnd("avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END)"),
        r_p01=rnd("quantile_cont(y, 0.01)"), r_p05=rnd("quantile_cont(y, 0.05)"), r_p25=rnd("quantile_cont(y, 0.25)"),
        r_p50=rnd("quantile_cont(y, 0.5)"), r_p75=rnd("quantile_cont(y, 0.75)"), r_p95=rnd("quantile_cont(y, 0.95)"),
        r_p99=rnd("quantile_cont(y, 0.99)"), r_skew=rnd("skewness(y)"), r_kurt=rnd("kurtosis(y)"))


@register("describe_panel", f"""
WITH {panel_sql('H')}
{_describe_sql('panel')}""")
def q_describe(spark, sf):
    return rounded(A.describe(panel(spark, sf, "H")))


@register("describe_raw_with_missing", f"""
WITH {RAW_SERIES_SQL}
{_describe_sql('rs')}""")
def q_describe_raw(spark, sf):
    """A-4..A-6 on the raw series with NULL targets."""
    return rounded(A.describe(_raw_series(spark, sf)))


# ---------------------------------------------------------------- A-7

@register("seasonal_profiles", f"""
WITH {panel_sql('H')}
SELECT unique_id, 'hourly' AS profile, CAST(hour(ds) AS BIGINT) AS key, {rnd('avg(y)')} AS y FROM panel GROUP BY 1, 2, 3
UNION ALL SELECT unique_id, 'weekly', CAST(isodow(ds) - 1 AS BIGINT), {rnd('avg(y)')} FROM panel GROUP BY 1, 2, 3
UNION ALL SELECT unique_id, 'monthly', CAST(month(ds) AS BIGINT), {rnd('avg(y)')} FROM panel GROUP BY 1, 2, 3""")
def q_profiles(spark, sf):
    return rounded(A.seasonal_profiles(panel(spark, sf, "H")))


@register("seasonal_profiles_daily", f"""
WITH {panel_sql('L')}
SELECT unique_id, 'hourly' AS profile, CAST(hour(ds) AS BIGINT) AS key, {rnd('avg(y)')} AS y FROM panel GROUP BY 1, 2, 3
UNION ALL SELECT unique_id, 'weekly', CAST(isodow(ds) - 1 AS BIGINT), {rnd('avg(y)')} FROM panel GROUP BY 1, 2, 3
UNION ALL SELECT unique_id, 'monthly', CAST(month(ds) AS BIGINT), {rnd('avg(y)')} FROM panel GROUP BY 1, 2, 3""")
def q_profiles_daily(spark, sf):
    return rounded(A.seasonal_profiles(panel(spark, sf, "L")))


# ---------------------------------------------------------------- A-12, P-13

VALIDATION_SQL = """
v_gaps AS (SELECT unique_id, (epoch_us(ds) - epoch_us(lag(ds) OVER (PARTITION BY unique_id ORDER BY ds))) / 1e6 AS gap
           FROM {src} WHERE ds IS NOT NULL),
v_irr AS (SELECT unique_id, count(*) FILTER (WHERE gap IS NOT NULL AND gap <> {step}) AS irregular FROM v_gaps GROUP BY 1),
v_stats AS (SELECT unique_id, count(*) AS n,
                   count(*) - count(DISTINCT ds) - CASE WHEN count(*) FILTER (WHERE ds IS NULL) > 0 THEN 1 ELSE 0 END AS dups,
                   count(*) FILTER (WHERE y IS NULL) AS missing,
                   avg(CASE WHEN y < 0 THEN 1.0 ELSE 0.0 END) AS neg_share
            FROM {src} GROUP BY 1),
v AS (SELECT s.*, coalesce(i.irregular, 0) AS irregular FROM v_stats s LEFT JOIN v_irr i USING (unique_id))
SELECT unique_id, test, status, {r_obs} AS observed FROM (
  SELECT unique_id, 'required_columns' AS test, 'pass' AS status, 1.0 AS observed FROM v
  UNION ALL SELECT unique_id, 'no_duplicate_timestamps', CASE WHEN dups = 0 THEN 'pass' ELSE 'fail' END, dups FROM v
  UNION ALL SELECT unique_id, 'no_missing_target', CASE WHEN missing = 0 THEN 'pass' ELSE 'fail' END, missing FROM v
  UNION ALL SELECT unique_id, 'regular_frequency',
      CASE WHEN n > 1 THEN CASE WHEN irregular = 0 THEN 'pass' ELSE 'warn' END ELSE 'fail' END, irregular FROM v
  UNION ALL SELECT unique_id, 'enough_history', CASE WHEN n >= 192 THEN 'pass' ELSE 'fail' END, n FROM v
  UNION ALL SELECT unique_id, 'non_negative_target', CASE WHEN neg_share = 0 THEN 'pass' ELSE 'warn' END, neg_share FROM v)"""


@register("validate_panel", f"""
WITH {panel_sql('H')}, {VALIDATION_SQL.format(src='panel', step=3600, r_obs=rnd('CAST(observed AS DOUBLE)'))}""")
def q_validate_panel(spark, sf):
    return rounded(A.validate_series(panel(spark, sf, "H")))


@register("validate_sparse_hours", f"""
WITH rawh AS ({raw_panel_sql('H')}), {VALIDATION_SQL.format(src='rawh', step=3600, r_obs=rnd('CAST(observed AS DOUBLE)'))}""")
def q_validate_sparse(spark, sf):
    """A-12 on the hourly panel before the grid: irregular steps → warn."""
    return rounded(A.validate_series(raw_panel(spark, sf, "H")))
