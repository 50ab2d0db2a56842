"""Published goldens: metrics, test statistics, p-values and bands recomputed
by our Spark operators from the reference's published predictions."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tests import golden_data as G
from tspanel.functions import stats_math as SM
from tspanel.operators import diagnose as D
from tspanel.operators import evaluate as E


def _preds(spark, rows):
    data = [("s", m, int(w), i % 24 + 1, float(y), float(p)) for i, (m, w, y, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "unique_id string, model string, window int, horizon int, y double, y_pred double")
    return df.withColumn("residual", F.col("y") - F.col("y_pred"))


def test_pipeline_metrics_match_published(spark):
    bw = E.metrics_by_window(_preds(spark, G.PIPELINE_BACKTEST), None, form="masked")
    board = {r["model"]: r for r in E.leaderboard(bw).collect()}
    for model, smape in G.PIPELINE_SMAPE.items():
        assert board[model]["smape"] == pytest.approx(smape, rel=1e-12)
        assert board[model]["mae"] == pytest.approx(G.PIPELINE_MAE[model], rel=1e-12)
    assert board["seasonal_naive_168"]["rank"] == 1


@pytest.mark.parametrize("rows,expected", [(G.RF_WINDOW_1, G.RF_WINDOW_1_METRICS),
                                           (G.RIDGE_WINDOW_3, G.RIDGE_WINDOW_3_METRICS)])
def test_clamped_metrics_match_published(spark, rows, expected):
    data = [("s", "m", 1, float(y), float(p)) for y, p in rows]
    df = spark.createDataFrame(data, "unique_id string, model string, window int, y double, y_pred double")
    r = E.metrics_by_window(df, None, form="clamped").first()
    assert (r["mae"], r["rmse"], r["mape"], r["smape"]) == pytest.approx(expected, rel=1e-8)


def test_pipeline_statistical_tests_match_published(spark):
    df = _preds(spark, G.PIPELINE_BACKTEST)
    out = {r["test"]: r for r in D.pipeline_tests(df, final_model="seasonal_window_average").collect()}
    assert out["bias_ttest"]["statistic"] == pytest.approx(G.BIAS_T[0], rel=1e-9)
    assert out["bias_ttest"]["pvalue"] == pytest.approx(G.BIAS_T[1], rel=1e-8)
    assert out["ljung_box_lag_24"]["statistic"] == pytest.approx(G.LJUNG_BOX_24[0], rel=1e-9)
    assert out["ljung_box_lag_24"]["pvalue"] == pytest.approx(G.LJUNG_BOX_24[1], rel=1e-6)
    assert out["ljung_box_lag_24"]["status"] == "warn"
    assert out["paired_ttest_vs_seasonal_naive_168"]["statistic"] == pytest.approx(G.PAIRED_T[0], rel=1e-8)
    assert out["paired_ttest_vs_seasonal_naive_168"]["pvalue"] == pytest.approx(G.PAIRED_T[1], rel=1e-8)
    assert out["bias_ttest"]["status"] == "pass"


def test_pvalue_helpers():
    assert SM.adf_pvalue(G.ADF[0]) == pytest.approx(G.ADF[1], rel=1e-3)
    assert SM.chi2_sf(G.LJUNG_BOX_24[0], 24) == pytest.approx(G.LJUNG_BOX_24[1], rel=1e-9)
    assert SM.t_two_sided(G.BIAS_T[0], 119) == pytest.approx(G.BIAS_T[1], rel=1e-9)
    assert SM.chi2_sf(3.0, 3) == pytest.approx(0.3916251762710877, rel=1e-9)   # odd df, incomplete gamma


def test_chi2_even_closed_form_matches_series(spark):
    row = spark.range(1).select(SM.chi2_sf_even_expr(F.lit(G.LJUNG_BOX_24[0]), 24).alias("p")).first()
    assert row["p"] == pytest.approx(G.LJUNG_BOX_24[1], rel=1e-9)


def test_band_scale_published_row(spark):
    """F-8: both published band levels imply one scale."""
    pred, lo80, hi80, lo95, hi95 = G.NAIVE_BAND_ROW
    s80 = (hi80 - pred) / 1.28
    s95 = (hi95 - pred) / 1.96
    assert s80 == pytest.approx(s95, rel=1e-12)
    from tspanel.operators.baselines import with_bands
    fc = spark.createDataFrame([("s", 1, 10, 1, "naive", pred)],
                               "unique_id string, window int, cut long, horizon int, model string, y_pred double")
    sc = spark.createDataFrame([("s", 1, 10, s80)], "unique_id string, window int, cut long, scale double")
    r = with_bands(fc, sc).first()
    assert (r["lower_80"], r["upper_80"], r["lower_95"], r["upper_95"]) == pytest.approx((lo80, hi80, lo95, hi95), rel=1e-12)
    assert not math.isnan(r["lower_80"])


@pytest.mark.parametrize("t, df", [(1.3, 1), (2.1, 2), (1.7, 9), (-0.4, 119)])
def test_t_tail_against_the_integrated_density(t, df):
    import numpy as np
    x, step = np.linspace(0.0, abs(t), 20_001, retstep=True)
    scale = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
    y = scale * (1 + x * x / df) ** (-(df + 1) / 2)
    area = step / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())
    assert SM.t_two_sided(t, df) == pytest.approx(1 - 2 * area, abs=1e-10)
    with pytest.raises(ValueError):
        SM.t_two_sided(t, df + 0.5)
