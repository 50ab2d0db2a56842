"""The streaming R-1 / N-2 produce the batch results on the same rows."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tspanel.sources.panels import panel
from tspanel.streaming.hourly import iqr_bounds, score_seasonal_iqr, stream_resample_mean


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
def test_stream_hourly_means_and_flags(spark):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
                   .option("maxFilesPerTrigger", 1).parquet(SMALL))
    hourly = stream_resample_mean(stream, "event_type", "ts", "value")
    bounds = iqr_bounds(panel(spark, SMALL, "H", fill="none").filter(F.col("y").isNotNull()))
    scored = score_seasonal_iqr(hourly, bounds)
    ckpt = tempfile.mkdtemp(prefix="tspanel-stream-", dir="/tmp")
    q = (scored.writeStream.format("memory").queryName("scored_h").outputMode("complete")
               .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM scored_h")
    batch = (events.groupBy(F.col("event_type").alias("unique_id"), F.date_trunc("hour", "ts").alias("ds"))
                   .agg(F.avg("value").alias("y")))
    assert got.count() == batch.count()
    diff = got.join(batch.withColumnRenamed("y", "yb"), ["unique_id", "ds"]).filter(F.abs(F.col("y") - F.col("yb")) > 1e-9)
    assert diff.count() == 0
    assert got.filter("seasonal_expected IS NULL").count() == 0
