"""Properties of the model-based operators on the driver tables (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from reachlens.operators import anomaly as AN
from reachlens.operators import causal as CA
from reachlens.operators import features as FE
from reachlens.operators import forecast as FC
from reachlens.operators import matching as MA
from reachlens.operators import models as MO
from reachlens.operators import timeseries as TS
from reachlens.sources import adapters as A
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def vc(spark):
    v = A.videos(spark, SF_SMALL).cache()
    return v, A.channels(spark, SF_SMALL, v).cache()


def test_matching_is_one_to_one(spark, vc):
    v, c = vc
    p = MO.propensity_scores(c, v).cache()
    nt = p.where("treated = 1").count()
    nc = p.where("treated = 0").count()
    pairs = MA.match_nearest(p.where("treated = 1"), p.where("treated = 0")).cache()
    assert pairs.count() == min(nt, nc)
    assert pairs.select("treated_channel_id").distinct().count() == pairs.count()
    assert pairs.select("control_channel_id").distinct().count() == pairs.count()
    assert pairs.join(p.where("treated = 1").select(F.col("channel_id").alias("control_channel_id")),
                      "control_channel_id").count() == 0
    att = CA.att_ttest(MA.matched_outcomes(pairs, p)).first()
    assert att["n_pairs"] == pairs.count() and 0 <= att["p_value"] <= 1


def test_matching_prefers_nearest(spark):
    t = spark.createDataFrame([(1, 0.50), (2, 0.90)], "channel_id long, propensity double")
    c = spark.createDataFrame([(10, 0.10), (11, 0.49), (12, 0.95), (13, 0.52)], "channel_id long, propensity double")
    got = {r[0]: r[1] for r in MA.match_nearest(t, c).collect()}
    assert got == {1: 11, 2: 12}


def test_churn_model_auc_above_chance(spark, vc):
    v, c = vc
    feat = FE.churn_features(c, v, 365)
    res = MO.train_churn_model(feat, max_iter=10)
    aucs = {r["model"]: r["auc"] for r in res["auc"].collect()}
    assert aucs["gbt"] > 0.5
    rep = res["report"].collect()
    assert {r["class"] for r in rep} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert res["scores"].count() == c.count()


def test_video_predictor_metrics_finite(spark, vc):
    v, c = vc
    out = MO.train_video_predictor(FE.video_features(c, v), max_iter=5)
    m = out["metrics"].first()
    assert m["mape"] is not None and m["mape"] < 10
    assert sum(r["importance"] for r in out["importance"].collect()) == pytest.approx(1.0)


def test_anomaly_rate_is_small(spark, vc):
    v, _ = vc
    a = AN.detect_anomalies(v, n_trees=30).cache()
    rate = a.agg(F.avg(F.col("is_anomaly").cast("double"))).first()[0]
    if_rate = a.agg(F.avg(F.col("if_anomaly").cast("double"))).first()[0]
    assert 0 < rate < 0.5
    assert if_rate == pytest.approx(0.05, abs=0.01)
    assert dict(a.dtypes)["is_anomaly"] == "boolean"


def test_forecast_horizon_and_comparison(spark, vc):
    v, _ = vc
    s = TS.weekly_series(v)
    f = FC.forecast_series(s, 6).cache()
    per = f.groupBy("channel_id", "model").count().select("count").distinct().collect()
    assert [r[0] for r in per] == [6]
    assert s.where("views < 0").count() == 0
    cmp = FC.compare_forecasts(s, 4, include_pooled=False)
    assert cmp.where("mape IS NULL OR mape < 0").count() == 0


def test_segments_and_pca(spark, vc):
    v, c = vc
    feat = FE.cluster_features(c, v)
    seg, prof = MO.segment_creators(feat, k=5, n_init=2)
    assert seg.count() == feat.count()
    assert {r[0] for r in seg.select("segment").distinct().collect()} <= set(MO.SEGMENT_NAMES)
    proj, ev = MO.pca_projection(feat)
    assert proj.count() == feat.count() and ev.count() == 2


def test_growth_regression_tables(spark, vc):
    v, c = vc
    out = MO.growth_regression(FE.regression_features(c, v))
    ols = out["ols"].collect()
    assert ols[0]["term"] == "const"
    assert all(0 <= r["p_value"] <= 1 for r in ols if r["p_value"] == r["p_value"])
    assert out["cv"].count() == 2


def test_sparse_seasonal_naive_equals_dense(spark, vc):
    v, _ = vc
    dense = TS.seasonal_naive_eval(TS.weekly_series(v), steps=8).toPandas().sort_values("channel_id")
    sparse = TS.seasonal_naive_holdout(v, steps=8).toPandas().sort_values("channel_id")
    assert list(dense["channel_id"]) == list(sparse["channel_id"])
    assert (dense["n_test"].to_numpy() == sparse["n_test"].to_numpy()).all()
    assert dense["mape"].to_numpy() == pytest.approx(sparse["mape"].to_numpy())
    assert dense["rmse"].to_numpy() == pytest.approx(sparse["rmse"].to_numpy())
