"""Steps whose cost must follow their input: filled series, moments, folds and fits of many rounds."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from reachlens.operators import clustering as CL
from reachlens.operators import forecast as FC
from reachlens.operators import models as MO
from reachlens.operators import timeseries as TS
from tests import plain_forecasts as plain

MONDAY = dt.datetime(2020, 1, 6)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def uploads(spark):
    rows = [(c, MONDAY + dt.timedelta(days=7 * w, hours=c or 0), v) for c, w, v in [
        (1, 0, 5), (1, 0, 2), (1, 3, 7), (1, 4, 1), (2, 2, 9), (None, 0, 4), (None, 2, 6), (3, 1, None), (3, 2, 8)]]
    return spark.createDataFrame([*rows, (4, None, 3), (1, None, 3)], "channel_id long, publish_time timestamp, views long")


@pytest.fixture(scope="module")
def weekly(spark):
    rng = np.random.default_rng(5)
    out = {k: np.where(rng.random(n) < 0.3, rng.integers(1, 900, n), 0) for k, n in enumerate([1, 3, 4, 5, 7, 8, 9, 30, 71])}
    out[20], out[21] = np.zeros(25, int), rng.integers(1, 900, 40)
    rows = [(k, (MONDAY + dt.timedelta(days=7 * i + 6)).date(), i, int(v)) for k, y in out.items() for i, v in enumerate(y)]
    return out, spark.createDataFrame(rows, "channel_id long, week_end date, week_idx int, views long").repartition(5)


def test_weekly_series_is_filled_without_a_join(uploads):
    s = TS.weekly_series(uploads)
    assert "Join" not in _plan(s)
    got = {(r.channel_id, r.week_idx): r.views for r in s.collect()}
    # without a channel there are weeks, but no values
    assert got == {(1, 0): 7, (1, 1): 0, (1, 2): 0, (1, 3): 7, (1, 4): 1, (2, 0): 9, (None, 0): 0, (None, 1): 0, (None, 2): 0, (3, 0): 0, (3, 1): 8}
    first = {r.channel_id: r.week_end for r in s.where("week_idx = 0").collect()}
    assert first[2] == dt.date(2020, 1, 26) and first[1] == dt.date(2020, 1, 12)


def test_moments_neither_sort_nor_shuffle_the_filled_series(weekly):
    series, df = weekly
    ar, trend = FC.ar_moments(df), FC.trend_moments(df)
    assert "Window" not in _plan(ar) and "Window" not in _plan(trend)
    for r in ar.collect():
        y = series[r.channel_id].astype(float)
        assert r.n == len(y)
        assert r.tail == [y[-1 - k] if k < len(y) else None for k in range(FC.SEASON)]
        for m in range(FC.SEASON + 1):
            lags = [y[m - a:len(y) - a] for a in range(m + 1)]
            none = len(y) <= m
            assert r[f"s_{m}"] == [None if none else x.sum() for x in lags]
            assert r[f"p_{m}"] == [None if none else (lags[a] * lags[b]).sum() for a, b in FC.pairs(range(m + 1), 2)]
    for r in trend.collect():
        y = series[r.channel_id].astype(float)
        assert (r.n, r.yy, r.xy[0]) == (len(y), (y * y).sum(), y.sum()) and np.isclose(r.xy[1], (np.arange(len(y)) * y).sum())


def test_weekly_values(weekly):
    series, df = weekly
    own = FC.packed(df)
    for r in own.select("channel_id", FC.weekly_values(F.col("w"), F.col("n")).alias("y")).collect():
        assert r.y == series[r.channel_id].tolist()


def test_holt_winters_is_compiled(weekly):
    series, df = weekly
    fitted = FC.holt_winters(df, 5)
    assert "aggregate(" not in _plan(fitted)
    rows = {r.channel_id: r.f for r in fitted.collect()}
    assert rows.keys() == series.keys()
    for k, y in series.items():
        assert np.allclose(rows[k], plain.fit_holt_winters(y.astype(float), 5)[0], rtol=1e-6, atol=1e-6 * max(y.max(), 1))


def test_pooled_windows(spark, weekly):
    series, df = weekly
    rows = FC.forecast_pooled_gbt(df, 3, max_iter=2).collect()
    # ten windows of eight weeks and the next at least
    assert {r.channel_id for r in rows} == {k for k, y in series.items() if len(y) >= 18}
    assert all(r.forecast is not None for r in rows) and len(rows) == 3 * len({r.channel_id for r in rows})


def test_fits_run_on_no_more_partitions_than_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    many = spark.range(400).repartition(40).select(
        F.col("id").alias("video_id"), *[(F.xxhash64("id", F.lit(i)) % 50).cast("double").alias(c) for i, c in enumerate(MO.VIDEO_FEATURES)],
        (F.col("id") % 7).cast("double").alias("log_views"))
    test = MO.train_video_predictor(many, max_iter=2)["test"]
    assert test.rdd.getNumPartitions() <= cores
    assert test.count() == MO.hash_split(many, "video_id").where("not is_train").count()


def test_distances_as_before():
    rng = np.random.default_rng(3)
    x, c = rng.normal(size=(200, 6)), rng.normal(size=(5, 6))
    assert np.allclose(CL._distances(x, c), np.square(x[:, None, :] - c[None, :, :]).sum(axis=2), rtol=1e-14)
