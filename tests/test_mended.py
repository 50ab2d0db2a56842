"""Cases that earlier versions got wrong."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import panel_df
from tspanel.operators import baselines as B
from tspanel.operators import diagnose as D
from tspanel.operators import profile as A
from tspanel.operators.prepare import last_n
from tspanel.operators.quantiles import exact_quantiles
from tspanel.sources.readers import read_metrics_table


def hourly(values, uid="a"):
    return [(uid, str(t), v) for t, v in zip(pd.date_range("2024-01-01", periods=len(values), freq="h"), values, strict=True)]


def test_residual_scale_of_a_steep_trend(spark):
    y = 1e7 * np.arange(400) + np.random.default_rng(1).normal(size=400)
    p = panel_df(spark, hourly(y.tolist()))
    cuts = spark.createDataFrame([("a", 1, 400), ("a", 2, 300)], "unique_id string, window int, cut long")
    got = {r["window"]: r["scale"] for r in B.residual_scale(p, cuts).collect()}
    for w, cut in ((1, 400), (2, 300)):
        d = y[:cut][24:] - y[:cut][:-24]
        assert abs(got[w] - d.std()) < 1e-5 * d.std()


def test_history_cap_binds_only_when_asked_for(spark):
    p = panel_df(spark, hourly([0.0] * 100 + list(np.linspace(0, 50, 100))))
    cuts = spark.createDataFrame([("a", 1, 200)], "unique_id string, window int, cut long")
    whole, capped = (B.drift(p, cuts, 1, max_history=m).first()["y_pred"] for m in (None, 50))
    assert abs(whole - (50 + 50 / 199)) < 1e-9 and capped > whole


def test_rows_are_counted_not_positions(spark):
    p = panel_df(spark, hourly([float(i) if i % 5 else None for i in range(1000)])).filter(F.col("y").isNotNull())
    assert last_n(p, 300).count() == 300


def test_acf_with_holes(spark):
    rng = np.random.default_rng(2)
    y = np.sin(np.arange(900) / 4) + rng.normal(size=900) * 0.1
    keep = rng.random(900) > 0.2
    got = D.acf(panel_df(spark, hourly([v if k else None for v, k in zip(y.tolist(), keep, strict=True)])), 30).orderBy("lag").toPandas()["acf"]
    e = y[keep] - y[keep].mean()
    want = [1.0] + [float((e[k:] * e[:-k]).sum() / (e * e).sum()) for k in range(1, 31)]
    assert np.allclose(got, want, atol=1e-9)


def test_quantiles_of_extreme_values(spark):
    for values in ([5e-324 * i for i in range(60)], [-1e308, 1e308] + [float(i) for i in range(80)]):
        df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
        row = exact_quantiles(df, ["k"], "v", [0.25, 0.5], cap=20, bins=16).first()
        assert np.allclose([row["q_0"], row["q_1"]], np.quantile(values, [0.25, 0.5]), rtol=1e-12, atol=1e-323)     # 5e-324 is the smallest double


def test_profiles_of_null_dates_and_flat_series(spark):
    df = spark.createDataFrame([("a", None, 1.0)] + [("a", f"2024-01-01 0{i}:00:00", 3.0) for i in range(6)], "unique_id string, ds string, y double") \
        .withColumn("ds", F.to_timestamp("ds"))
    assert A.seasonal_profiles(df).where("key IS NULL").count() == 0
    flat = A.describe(df.where("ds IS NOT NULL")).first()
    assert flat["skew"] == 0.0 and flat["kurtosis"] == 0.0


def test_missing_column_fails_the_check(spark):
    df = panel_df(spark, hourly([1.0] * 10)).drop("y", "pos")
    got = {r["test"]: r["status"] for r in A.validate_series(df).collect()}
    assert got["required_columns"] == "fail"


def test_paths_with_a_scheme(spark, tmp_path):
    f = tmp_path / "metrics.csv"
    f.write_text("model,mae\nnaive,1.5\n")
    assert [read_metrics_table(spark, p, "g").count() for p in (str(f), f"file://{f}", f"file://{tmp_path}/none.csv")] == [1, 1, 0]
