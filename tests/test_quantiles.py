"""Exact distributed quantiles equal numpy's linear-interpolation quantiles,
also when the histogram rounds are forced (tiny cap)."""

from __future__ import annotations

import numpy as np
import pytest

from tspanel.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("cap,bins", [(50_000, 4096), (200, 8)])
def test_exact_quantiles_match_numpy(spark, cap, bins):
    rng = np.random.default_rng(5)
    rows = []
    data = {"a": rng.lognormal(0, 2, 3000), "b": np.repeat([1.0, 2.0, 2.0, 3.0], 50), "c": np.array([4.2])}
    data["a"][::97] = 0.0
    for g, v in data.items():
        rows += [(g, float(x)) for x in v]
    rows += [("d", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs, cap=cap, bins=bins).collect()}
    for g, v in data.items():
        for i, p in enumerate(probs):
            assert out[g][f"q_{i}"] == pytest.approx(float(np.quantile(v, p)), rel=1e-12, abs=1e-15)
    assert "d" not in out                      # no values → no row (callers left-join)


@pytest.mark.parametrize("cap,bins", [(1, 2), (7, 3), (50_000, 4096)])
def test_ties_and_uneven_groups(spark, cap, bins):
    rng = np.random.default_rng(9)
    data = {"hot": rng.integers(0, 40, 4000).astype(float), "two": np.array([-3.5, 9.0]), "zero": np.array([0.0, -0.0, 0.0]),
            "wide": np.r_[rng.normal(size=200) * 1e-9, 1e12, -1e12]}
    df = spark.createDataFrame([(g, float(x)) for g, v in data.items() for x in v] + [(None, 1.0), ("nan", float("nan"))], "g string, v double")
    probs = [0.0, 0.05, 0.5, 0.5, 0.95, 1.0]
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs, cap=cap, bins=bins).collect()}
    assert set(out) == set(data)
    for g, v in data.items():
        assert [out[g][f"q_{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(v, probs)), rel=1e-12, abs=1e-21), g


def test_no_values(spark):
    df = spark.createDataFrame([("a", None)], "g string, v double")
    assert exact_quantiles(df, ["g"], "v", [0.5]).collect() == []
