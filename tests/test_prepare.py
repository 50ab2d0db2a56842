"""Regularisation, gap filling, typing and profiling on synthetic edge cases,
checked against pandas (the reference's library) semantics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from tests.conftest import panel_df
from tspanel.operators import prepare as P
from tspanel.operators import profile as A
from tspanel.sources.readers import parse_raw_sensor


def _gaps_rows():
    rng = np.random.default_rng(3)
    base = pd.Timestamp("2024-03-01 00:00:00")
    rows = []
    for i in range(48):
        if i in (0, 1, 20, 21, 22, 46, 47):      # holes at start, middle (3 wide) and end
            continue
        rows.append(("a", str(base + pd.Timedelta(hours=i)), float(rng.normal(10, 2))))
    rows.append(("a", str(base + pd.Timedelta(hours=10, minutes=30)), 99.0))   # off-grid row
    return rows


def _pandas_fill(rows, method):
    pdf = pd.DataFrame(rows, columns=["unique_id", "ds", "y"])
    pdf["ds"] = pd.to_datetime(pdf["ds"])
    s = pdf.sort_values("ds").drop_duplicates("ds").set_index("ds")["y"].asfreq("h")
    if method in ("interpolate", "time"):
        s = s.interpolate(method="linear" if method == "interpolate" else "time", limit_direction="both")
    elif method == "ffill":
        s = s.ffill().bfill()
    return s


@pytest.mark.parametrize("method", ["interpolate", "time", "ffill", "none"])
@pytest.mark.parametrize("bucket", [8192, 4])
def test_regularize_matches_pandas(spark, method, bucket):
    rows = _gaps_rows()
    df = panel_df(spark, rows, with_pos=False)
    out = P.regularize(df, 3600, fill=method, bucket=bucket).orderBy("pos").toPandas()
    expected = _pandas_fill(rows, method)
    assert len(out) == len(expected) == 44          # first to last, off-grid row dropped
    assert list(out["pos"]) == list(range(1, 45))
    np.testing.assert_allclose(out["y"].to_numpy(dtype=float), expected.to_numpy(dtype=float), rtol=1e-12,
                               equal_nan=True)


def test_unknown_fill_method_raises(spark):
    with pytest.raises(ValueError):
        P.regularize(panel_df(spark, _gaps_rows(), with_pos=False), 3600, fill="spline")


def test_grid_count_two_ids(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 05:00:00", 2.0),
            ("b", "2024-01-02 03:00:00", 5.0), ("b", "2024-01-02 04:00:00", 6.0)]
    out = P.regularize(panel_df(spark, rows, with_pos=False), 3600).groupBy("unique_id").count().orderBy("unique_id").collect()
    assert [(r["unique_id"], r["count"]) for r in out] == [("a", 6), ("b", 2)]


def test_resample_sum_min_count(spark):
    rows = [("a", "2024-01-01 00:10:00", 1.0), ("a", "2024-01-01 00:20:00", 2.0),
            ("a", "2024-01-01 01:10:00", float("nan")), ("a", "2024-01-01 02:05:00", 4.0)]
    df = panel_df(spark, rows, with_pos=False)
    out = {str(r["ds"]): r["y"] for r in P.resample(df, 3600, "sum").collect()}
    assert out["2024-01-01 00:00:00"] == 3.0
    assert out["2024-01-01 01:00:00"] is None        # all missing → NULL, not 0
    mean = P.resample(df, 3600, "mean", densify=True).orderBy("pos").collect()
    assert [r["y"] for r in mean] == [1.5, None, 4.0]
    with pytest.raises(ValueError):
        P.resample(df, 3600, "median")


def test_raw_sensor_parse_tokens_and_dups(spark):
    rows = [("16/12/2006", "17:24:00", "4.216", "0.418", 0),
            ("16/12/2006", "17:24:00", "9.999", "1", 1),            # duplicate timestamp → first kept
            ("16/12/2006", "17:25:00", "?", "NaN", 2),
            ("31/02/2006", "17:26:00", "1.0", "", 3),                # invalid date → NULL ds
            ("16/12/2006", "17:27:00", "abc", "None", 4)]
    df = spark.createDataFrame(rows, "Date string, Time string, Global_active_power string, Sub_metering_1 string, _row long")
    out = {str(r["ds"]): r for r in parse_raw_sensor(df).collect()}
    assert out["2006-12-16 17:24:00"]["Global_active_power"] == 4.216
    assert out["2006-12-16 17:25:00"]["Global_active_power"] is None
    assert out["2006-12-16 17:25:00"]["Sub_metering_1"] is None     # NaN token → NULL, never NaN
    assert out["2006-12-16 17:27:00"]["Global_active_power"] is None
    assert "None" in out                                          # the NULL-date row kept once


def test_dedupe_keep_first(spark):
    df = spark.createDataFrame([("a", 1, 5.0, 2), ("a", 1, 7.0, 1), ("a", 2, 1.0, 3)],
                               "unique_id string, k int, v double, o int")
    out = {r["k"]: r["v"] for r in P.dedupe_keep_first(df, ["unique_id", "k"], "o").collect()}
    assert out == {1: 7.0, 2: 1.0}


def test_quality_report_and_steps(spark):
    rows = [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 01:00:00", 2.0),
            ("a", "2024-01-01 01:00:00", 3.0), ("a", "2024-01-01 03:00:00", float("nan")),
            ("a", "2024-01-01 04:00:00", -1.0)]
    r = A.quality_report(panel_df(spark, rows, with_pos=False)).first()
    assert (r["rows"], r["duplicate_dates"], r["missing_target"]) == (5, 1, 1)
    assert (r["most_common_step"], r["min_step"], r["max_step"]) == (3600.0, 0.0, 7200.0)
    assert r["target_median"] == 1.5


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(0)
    y = rng.gamma(2.0, 2.0, 500)
    y[::50] = 0.0
    rows = [("a", str(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)), float(v)) for i, v in enumerate(y)]
    r = A.describe(panel_df(spark, rows, with_pos=False)).first()
    s = pd.Series(y)
    assert r["std"] == pytest.approx(s.std(), rel=1e-10)
    assert r["skew"] == pytest.approx(s.skew(), rel=1e-9)
    assert r["kurtosis"] == pytest.approx(s.kurtosis(), rel=1e-9)
    for p in (1, 5, 25, 50, 75, 95, 99):
        assert r[f"p{p:02d}"] == pytest.approx(s.quantile(p / 100), rel=1e-12)
    assert r["zero_count"] == 10


def test_validation_statuses(spark):
    rows = [("a", str(pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i)), 1.0) for i in range(200)]
    rows += [("b", "2024-01-01 00:00:00", -1.0), ("b", "2024-01-01 02:00:00", float("nan"))]
    out = {(r["unique_id"], r["test"]): r["status"] for r in A.validate_series(panel_df(spark, rows, with_pos=False)).collect()}
    assert out[("a", "enough_history")] == "pass" and out[("a", "regular_frequency")] == "pass"
    assert out[("b", "regular_frequency")] == "warn" and out[("b", "non_negative_target")] == "warn"
    assert out[("b", "no_missing_target")] == "fail" and out[("b", "enough_history")] == "fail"


def test_flatten_report(spark):
    df = spark.createDataFrame([("a", 3, 1.5)], "unique_id string, rows long, mean double")
    out = {r["metric"]: r["value"] for r in A.flatten_report(df, "raw").collect()}
    assert out == {"rows": "3", "mean": "1.500000"}


def test_nan_never_reaches_aggregates(spark):
    rows = [("a", "2024-01-01 00:00:00", float("nan")), ("a", "2024-01-01 01:00:00", 2.0)]
    r = A.describe(panel_df(spark, rows, with_pos=False)).first()
    assert r["mean"] == 2.0 and r["missing_count"] == 1
    assert not math.isnan(r["mean"])
