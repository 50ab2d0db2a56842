"""A hot series (most of the rows) is spread over many tasks by the bucket +
halo layout; results equal the unbucketed computation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import panel_df
from tspanel.operators import baselines as B
from tspanel.operators import windowing as hw


def _panel(spark):
    rng = np.random.default_rng(11)
    base = pd.Timestamp("2020-01-01")
    rows = [("hot", str(base + pd.Timedelta(hours=i)), float(v)) for i, v in enumerate(rng.normal(10, 1, 20000))]
    rows += [(f"cold{k}", str(base + pd.Timedelta(hours=i)), float(k + i % 24)) for k in range(5) for i in range(400)]
    return panel_df(spark, rows).checkpoint(eager=True)


def test_hot_series_spreads_over_buckets(spark):
    p = _panel(spark)
    w = hw.series_window()
    cols = {"lag_168": F.lag("y", 168).over(w), "mean_24": F.avg("y").over(w.rowsBetween(-24, -1))}
    small = hw.rolling(p, cols, behind=168, bucket=2048)
    # the hot series is cut into ceil(20000 / 2048) = 10 window partitions
    parts = hw.with_halo(p.filter("unique_id = 'hot'"), 168, 0, 2048).select(hw.BKT).distinct().count()
    assert parts == 10
    big = hw.rolling(p, cols, behind=168, bucket=10 ** 6)
    a = small.orderBy("unique_id", "pos").toPandas()
    b = big.orderBy("unique_id", "pos").toPandas()
    for c in cols:
        np.testing.assert_allclose(a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float), rtol=1e-12, equal_nan=True)


def test_lookup_join_keys_split_hot_series(spark):
    p = _panel(spark)
    cuts = B.pipeline_cutoffs(p)
    fc = B.pipeline_forecasts(p, cuts)
    # requests and panel rows meet on (unique_id, pos): the hot series' rows hash to every partition
    keyed = p.filter("unique_id = 'hot'").repartition(8, "unique_id", "pos")
    sizes = keyed.rdd.glom().map(len).collect()
    assert min(sizes) > 0 and max(sizes) < 0.5 * sum(sizes)
    assert fc.filter("unique_id = 'hot'").count() == 5 * 24 * 2
