"""Cases that used to fail: sampling of huge tables, NULL keys, empty cells and bands."""

import os

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from reachlens.operators import anomaly, causal, experiments, features, forecast, kpi, matching, models
from reachlens.sources import files


@pytest.mark.parametrize("n", [1, 1000, 10**9, 10**12])
def test_sample_limit_draws_about_what_is_wanted(n):
    share = anomaly.sample_limit(n, 512) / 2.0**63
    assert share * n == pytest.approx(min(n, 512), rel=1e-6)


def test_append_new_null_keys_and_order(spark, tmp_dir):
    rows = spark.createDataFrame([(None, "b"), (None, "a"), ("x", "d"), ("x", "c")], "k string, v string")
    path = os.path.join(tmp_dir, "t")
    assert files.append_new(rows, path, ["k"]) == 2
    assert files.append_new(rows, path, ["k"]) == 0
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(None, "a"), ("x", "c")}
    with pytest.raises(AnalysisException):
        files.append_new(rows.withColumnRenamed("k", "other"), path, ["other"])


def test_null_category_has_its_median(spark):
    c = spark.createDataFrame([(None, 1.0, 1), (None, 3.0, 1), (None, 5.0, 1), ("a", 2.0, 1)],
                              "category string, avg_weekly_uploads double, subscribers long")
    got = {r.category: (r.median_uploads_per_week, r.channel_count) for r in kpi.uploads_by_category(c).collect()}
    assert got == {None: (3.0, 3), "a": (2.0, 1)}


def test_no_division_errors(spark):
    pairs = spark.createDataFrame([], "treated_views double, control_views double")
    assert causal.att_ttest(pairs, with_p=False).first().att is None
    series = spark.createDataFrame([("a", t, 0.0, 1.0) for t in range(2)] + [("a", 5, 1.0, 2.0)]
                                   + [("b", t, float(t), float(t % 3)) for t in range(8)], "e string, t int, y double, x double")
    rows = causal.did_prepost(series, "e", "t", "y", "x", 4, with_p=False).collect()
    assert {r.e: r.pct_lift is None for r in rows} == {"a": True, "b": False}
    assert {r.e for r in causal.pre_post_counterfactual(series, "e", "t", "y", "x", 4).collect()} == {"a", "b"}
    flat = spark.createDataFrame([("f", 2.0)] * 3 + [("g", float(i)) for i in range(5)], "s string, v double")
    assert {r.s: r.n_per_group is None for r in experiments.power_grid(flat, "v", "s").collect()} == {"f": True, "g": False}


def test_unknown_factor_level_is_an_error(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (2, 1, 2.0)], "a int, b int, y double")
    with pytest.raises(Exception, match="must be 0 or 1"):
        experiments._cells(df, "a", "b", "y").collect()


def test_band_of_a_negative_forecast(spark):
    y = np.concatenate([np.full(60, 10.0), np.linspace(10, -80, 60)])
    rows = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(y)], "channel_id int, week_idx int, views double")
    f = forecast.holt_winters(rows.selectExpr("*", "date_add(date'2020-01-05', 7 * week_idx) AS week_end"), 12).first()
    assert min(f.f) < 0 and all(a <= b for a, b in zip(f.lo, f.hi))


def test_cross_validation_scales_within_folds(spark):
    """Ridge R2 by fold, against the closed form fitted on the other folds alone."""
    rng = np.random.default_rng(5)
    n, folds = 53, 5
    x = rng.normal(size=(n, 2)) * [3.0, 0.5] + np.arange(n)[:, None] / 10
    y = x @ [0.4, -1.5] + rng.normal(size=n)
    fold = np.arange(n) * folds // n
    want = []
    for k in range(folds):
        a, b = x[fold != k], x[fold == k]
        z, t = (a - a.mean(0)) / a.std(0), (b - a.mean(0)) / a.std(0)
        m = y[fold != k].mean()
        w = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y[fold != k] - m))
        own = y[fold == k]
        want.append(1 - ((own - m - t @ w) ** 2).sum() / ((own - own.mean()) ** 2).sum())
    df = spark.createDataFrame([(i, float(u), float(v), float(w)) for i, ((u, v), w) in enumerate(zip(x, y))],
                               "channel_id long, a double, b double, growth_rate double")
    got = {r["model"]: r["cv_r2"] for r in models.growth_regression(df)["cv"].collect()}
    assert got["ridge"] == pytest.approx(np.mean(want), abs=1e-6)


def test_rows_of_a_run_are_matched_by_distance(spark):
    t = spark.createDataFrame([(1, 0.50), (2, 0.51)], "channel_id long, propensity double")
    c = spark.createDataFrame([(10, 0.10), (11, 0.52), (12, 0.53)], "channel_id long, propensity double")
    assert {r[0]: r[1] for r in matching.match_nearest(t, c).collect()} == {1: 12, 2: 11}


@pytest.mark.parametrize("name", ["breakout", "first_days", "early", "retention", "anomalies", "video_features"])
def test_hot_entity_is_split(spark, name):
    """Two thirds of the rows belong to one entity; its join partition is split."""
    from pyspark.sql import functions as F

    from reachlens.operators import cohorts

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        v = spark.range(0, 120_000, 1, 8).select(
            F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("channel_id"), F.col("id").alias("video_id"), F.hash("id").cast("long").alias("views"),
            F.lit(1).cast("long").alias("likes"), F.lit(1).cast("long").alias("comment_count"),
            F.timestamp_seconds(F.col("id") * 977).alias("publish_time"))
        v = v.withColumn("title", F.lit("t")).withColumn("duration_seconds", F.lit(1))
        c = v.select("channel_id").distinct().select("channel_id", F.lit(1).alias("subscribers"), F.lit(1.0).alias("avg_weekly_uploads")).checkpoint()
        out = {"video_features": lambda x: features.video_features(c, x), "breakout": kpi.breakout_ratio, "first_days": kpi.uploads_in_first_days, "early": cohorts.early_volume,
               "retention": cohorts.creator_retention_view, "anomalies": anomaly.z_anomalies}[name](v)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
