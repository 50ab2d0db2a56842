"""Composite pipelines (PIPE-1..PIPE-6) run end to end on the sf0.001 tables."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tspanel.operators import ml as ML
from tspanel.operators.prepare import to_panel
from tspanel.plans import pipelines as PL
from tspanel.sources.panels import prepared_panel, raw_sensor_text
from tspanel.sources.readers import parse_raw_sensor

pytestmark = pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def hourly(spark):
    return prepared_panel(spark, SMALL, "H")


def test_prepare_pipeline(spark):
    out = PL.prepare_dataset(parse_raw_sensor(raw_sensor_text(spark, SMALL)))
    prepared = out["prepared"]
    assert prepared.filter(F.col("y").isNull()).count() == 0
    blocks = {r["block"] for r in out["quality"].select("block").distinct().collect()}
    assert blocks == {"raw", "hourly_before_fill", "prepared"}
    assert out["missing"].count() == 3            # ds + two numeric columns


def test_final_pipeline_writes_tables(spark, hourly):
    out_dir = tempfile.mkdtemp(prefix="tspanel-pipe-", dir="/tmp")
    out = PL.run_pipeline(hourly, out_dir)
    for name in out:
        assert os.path.isdir(os.path.join(out_dir, name))
    assert {r["test"] for r in out["validation"].collect()} >= {"required_columns", "enough_history"}
    assert spark.read.parquet(os.path.join(out_dir, "forecast")).count() == out["forecast"].count()


def test_eda_and_anomaly_bundles(hourly):
    eda = PL.eda_bundle(hourly)
    assert eda["acf"].filter("lag = 0").agg(F.min("acf")).first()[0] == pytest.approx(1.0)
    assert eda["stationarity"].count() == hourly.select("unique_id").distinct().count()
    an = PL.anomaly_analysis(hourly)
    assert an["summary"].count() == 4 * hourly.select("unique_id").distinct().count()


def test_statistical_and_data_driven_analysis(hourly):
    st = PL.statistical_analysis(hourly, with_fleet=True)
    models = {r["model"] for r in st["leaderboard"].collect()}
    assert {"naive", "manual_ets_additive", "auto_arima"} <= models
    assert st["diagnostics"].count() == hourly.select("unique_id").distinct().count()
    dd = PL.data_driven_analysis(hourly, ["ridge_regression"])
    assert {r["group"] for r in dd["combined"].collect()} == {"ML", "DL"}
    series = hourly.select("unique_id").distinct().count()
    assert {r["group"]: r["count"] for r in dd["forecasts"].groupBy("group").count().collect()} == {"ML": 24 * series, "DL": 24 * series}


def test_model_registry_and_to_panel(spark):
    from pyspark.ml.regression import LinearRegression

    ML.register_model("plain_linear", lambda: LinearRegression(featuresCol="features", labelCol="y"))
    try:
        assert "plain_linear" in ML.MODEL_REGISTRY
    finally:
        ML.MODEL_REGISTRY.pop("plain_linear")
    df = spark.createDataFrame([("2024-01-01 00:00:00", "1.5", "k")], "d string, v string, id string")
    row = to_panel(df, "d", "v", id_col="id").first()
    assert (row["unique_id"], row["y"]) == ("k", 1.5)
