"""Gaps by blocks of rows equal a plain sort, also with blocks of two rows and a series that holds most rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tspanel.operators import profile as A


@pytest.mark.parametrize("rows", [1, 2, 65_536])
def test_gaps_equal_a_plain_sort(spark, rows):
    rng, start = np.random.default_rng(4), datetime(2024, 1, 1)
    data = {"hot": [start + timedelta(seconds=int(s)) for s in rng.integers(0, 400, 600)],       # one dense stretch, many repeats
            "one": [start], "far": [start, start + timedelta(days=900), start + timedelta(days=900, microseconds=1)], "none": [None, None]}
    df = spark.createDataFrame([(u, t, 1.0) for u, ts in data.items() for t in ts], "unique_id string, ds timestamp, y double")
    got = A.consecutive_gaps(df, rows).groupBy("unique_id", "gap").agg(F.sum("times").alias("n")).collect()
    want = Counter()
    for u, ts in data.items():
        ts = sorted(t for t in ts if t is not None)
        want.update((u, (b - a) / timedelta(microseconds=1) / 1e6) for a, b in zip(ts, ts[1:]))
    assert {(r["unique_id"], r["gap"]): r["n"] for r in got} == dict(want)


def test_report_counts_repeats(spark):
    t = datetime(2024, 5, 1)
    df = spark.createDataFrame([("a", t, 1.0), ("a", t, 2.0), ("a", t, 2.0), ("a", t + timedelta(hours=1), 3.0), ("a", None, 4.0), ("a", None, 4.0)],
                               "unique_id string, ds timestamp, y double")
    r = A.quality_report(df, rows=2).first()
    assert (r["duplicate_dates"], r["min_step"], r["max_step"], r["most_common_step"], r["target_median"]) == (3, 0.0, 3600.0, 0.0, 2.5)
