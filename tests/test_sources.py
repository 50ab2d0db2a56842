"""File readers and sinks (S-1, S-2, S-4, S-6, S-7, S-8) and the J-4 join."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tspanel.operators import evaluate as E
from tspanel.operators import profile as A
from tspanel.sources import readers as RD


def _write(text: str, name: str) -> str:
    d = tempfile.mkdtemp(prefix="tspanel-src-", dir="/tmp")
    path = os.path.join(d, name)
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_read_simple_series_dedupes_first(spark):
    path = _write("ds,y,other\n2024-01-01 01:00:00,2,x\n2024-01-01 00:00:00,1,x\n2024-01-01 01:00:00,9,x\n"
                  "bad,3,x\n2024-01-01 02:00:00,abc,x\n", "s.csv")
    out = {str(r["ds"]): r["y"] for r in RD.read_simple_series(spark, path).collect()}
    assert out["2024-01-01 01:00:00"] == 2.0          # first occurrence in file order
    assert out["2024-01-01 02:00:00"] is None and out["None"] == 3.0
    with pytest.raises(ValueError):
        RD.read_simple_series(spark, path, target_col="missing")


def test_read_raw_sensor_file(spark):
    text = ("Date;Time;Global_active_power;Global_reactive_power;Voltage\n"
            "16/12/2006;17:24:00;4.216;0.418;234.840\n"
            "16/12/2006;17:25:00;?;0.436;233.630\n"
            "16/12/2006;17:24:00;5.0;0.1;230\n")
    raw = RD.read_raw_sensor(spark, _write(text, "household.txt"))
    rows = {str(r["ds"]): r for r in raw.collect()}
    assert rows["2006-12-16 17:24:00"]["Global_active_power"] == 4.216
    assert rows["2006-12-16 17:25:00"]["Global_active_power"] is None
    assert set(raw.columns) == {"ds", "Global_active_power", "Global_reactive_power", "Voltage"}
    assert A.missing_values_table(raw).first()["column"] == "Global_active_power"


def test_read_metrics_table_optional(spark):
    assert RD.read_metrics_table(spark, "/nonexistent/m.csv", "ML").count() == 0
    assert RD.read_metrics_table(spark, _write("a,b\n1,2\n", "nomodel.csv"), "ML").count() == 0
    t = RD.read_metrics_table(spark, _write("model,mae,smape\nrf,0.3,x\n", "m.csv"), "ML").first()
    assert (t["model"], t["mae"], t["smape"], t["mase"], t["group"]) == ("rf", 0.3, None, None, "ML")


def test_load_or_prepare_and_sink(spark):
    sample = _write("ds,y\n2024-01-01 00:00:00,1\n2024-01-01 02:00:00,3\n", "sample.csv")
    p = RD.load_or_prepare(spark, prepared_path="/nonexistent.parquet", raw_path=None, sample_path=sample)
    assert [r["y"] for r in p.orderBy("pos").collect()] == [1.0, 2.0, 3.0]
    out = tempfile.mkdtemp(prefix="tspanel-sink-", dir="/tmp") + "/prepared"
    RD.write_table(p.drop("pos"), out)
    back = RD.load_prepared(spark, out)
    assert back.count() == 3 and back.columns == ["unique_id", "ds", "y"]
    RD.write_table(p, out + "_pos")
    assert RD.load_prepared(spark, out + "_pos").columns == ["unique_id", "ds", "y", "pos"]
    with pytest.raises(FileNotFoundError):
        RD.load_or_prepare(spark)


def test_combine_selection_tables_right_join(spark):
    cols = "unique_id string, rank int, group string, model string, mae double, rmse double, smape double, mase double, comment string, decision string"
    ml = spark.createDataFrame([("s", 1, "ML", "rf", 9.0, 9.0, 9.0, 9.0, "trees", "x")], cols)
    dl = spark.createDataFrame([("s", 1, "DL", "net", 9.0, 9.0, 9.0, 9.0, "window", "x")], cols)
    board = spark.createDataFrame([("s", 1, "DL", "net", 1.0, 1.0, 5.0, 1.0), ("s", 2, "ML", "rf", 1.0, 1.0, 6.0, 1.0),
                                   ("s", 3, "ML", "new", 1.0, 1.0, 7.0, 1.0)],
                                  "unique_id string, rank int, group string, model string, mae double, rmse double, smape double, mase double")
    out = {r["model"]: r for r in E.combine_selection_tables([ml, dl], board).collect()}
    assert out["net"]["decision"] == "primary data-driven candidate" and out["net"]["smape"] == 5.0
    assert out["rf"]["comment"] == "trees" and out["new"]["comment"] == ""
    assert len(out) == 3


def test_window_numbers_per_series(spark):
    df = spark.createDataFrame([("a", "2024-01-02"), ("a", "2024-01-01"), ("a", "2024-01-01"), ("b", "2024-01-05")],
                               "unique_id string, cutoff string").withColumn("cutoff", F.to_timestamp("cutoff"))
    got = {(r["unique_id"], str(r["cutoff"].date())): r["window"] for r in A.window_numbers(df).collect()}
    assert got == {("a", "2024-01-01"): 1, ("a", "2024-01-02"): 2, ("b", "2024-01-05"): 1}
