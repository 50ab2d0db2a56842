from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tspanel.session import SESSION_CONF

    builder = SparkSession.builder.master("local[*]").appName("tspanel-tests")
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tspanel-test-ckpt-", dir="/tmp"))
    yield s


def panel_df(spark, rows, with_pos=True, step=3600):
    """Build a ``unique_id, ds, y`` frame from (id, 'YYYY-mm-dd HH:MM:SS', y) tuples."""
    import pandas as pd
    from pyspark.sql import functions as F

    pdf = pd.DataFrame(rows, columns=["unique_id", "ds", "y"])
    pdf["ds"] = pd.to_datetime(pdf["ds"])
    df = spark.createDataFrame(pdf, "unique_id string, ds timestamp, y double")
    df = df.withColumn("y", F.when(F.isnan("y"), None).otherwise(F.col("y")))
    if with_pos:
        from tspanel.operators.prepare import with_position
        df = with_position(df, step)
    return df
