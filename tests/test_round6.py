"""Findings of round 4: plans, memory and fits that grow with the tables."""

import datetime as dt

import numpy as np
import pytest

from reachlens.llm import suffix_dedup
from reachlens.operators import forecast as FC
from tests import plain_forecasts as plain


def _weekly(spark, series):
    rows = [(k, dt.date(2020, 1, 5) + dt.timedelta(days=7 * i), i, int(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "channel_id long, week_end date, week_idx int, views long").repartition(3)


@pytest.fixture(scope="module")
def sparse():
    """Series with uploads in some weeks only, of one week to ninety."""
    rng = np.random.default_rng(5)
    out = {}
    for k in range(40):
        n = int(rng.integers(20, 90)) if k > 9 else k + 1
        out[k] = np.where(rng.random(n) < 0.3, rng.integers(1, 100_000, n), 0)
        out[k][[0, -1]] = 7, 9
    return out


def test_comparison_plans_one_model_at_a_time(spark, sparse):
    """a plan of all models at once, with a projection a week, did not fit the driver."""
    got = FC.compare_forecasts(_weekly(spark, sparse), 4, include_pooled=False)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Project") < 30
    want = {}
    for k, y in sparse.items():
        split = int(len(y) * 0.8)
        own, rest = y[:split].astype(float), y[split:split + 4].astype(float)
        if split and len(rest):
            fits = {"arima": plain.fit_ar(own, 4)[0], "holt_winters": plain.fit_holt_winters(own, 4)[0],
                    "trend_seasonal": plain.fit_trend_seasonal(np.arange(split, dtype=float), own, 4)[0]}
            for model, f in fits.items():
                err = rest - np.asarray(f)[:len(rest)]
                want[k, model] = (np.mean(np.abs(err) / (rest + 1)), np.sqrt(np.mean(err * err)), len(rest))
    rows = {(r.channel_id, r.model): (r.mape, r.rmse, r.n_test) for r in got.collect()}
    assert rows.keys() == want.keys()
    for k, v in want.items():
        assert np.allclose(rows[k], v, rtol=1e-6, atol=1e-3), (k, rows[k], v)


def _windows(spark, series, lookback=8):
    rows = []
    for y in series.values():
        z = (y - y.mean()) / (y.std() + 1e-8)
        rows += [tuple(map(float, z[i:i + lookback + 1])) for i in range(len(z) - lookback)]
    return spark.createDataFrame(rows, [*[f"lag{k}" for k in range(lookback, 0, -1)], "y"]).repartition(2).localCheckpoint(), len(rows)


@pytest.mark.parametrize("n", [40, 400])
def test_windows_by_bins_fit_as_windows_do(spark, n):
    """up to 10 000 windows the bounds come from all, beyond that from a sample; both are those of a fit of the windows."""
    rng = np.random.default_rng(n)
    win, rows = _windows(spark, {k: np.where(rng.random(60) < 0.2, rng.integers(1, 9000, 60), 0) for k in range(n)})
    assert (rows > FC.SPLIT_ROWS) == (n == 400)
    lags = [c for c in win.columns if c != "y"]
    asm = FC.VectorAssembler(inputCols=lags, outputCol="features")
    want = FC.GBTRegressor(labelCol="y", maxIter=3, maxDepth=4, stepSize=0.1, seed=42).fit(asm.transform(win))
    counted, bins = FC.binned_windows(win, rows, lags, "y", 42)
    got = FC.GBTRegressor(labelCol="y", weightCol="_k", maxIter=3, maxDepth=4, stepSize=0.1, maxBins=1 << 10, seed=42).fit(asm.transform(counted))
    assert counted.agg({"_k": "sum"}).first()[0] == rows > 1.2 * counted.count()
    a = [r[0] for r in want.transform(asm.transform(win)).select("prediction").collect()]
    b = [r[0] for r in got.transform(asm.transform(FC.in_bins(bins, win, lags, "y"))).select("prediction").collect()]
    assert np.allclose(a, b, atol=1e-9)


def test_pooled_fit_reads_no_window_twice(spark, sparse, monkeypatch):
    """the fit held and read every window; those in the same bins are one row now."""
    fitted = []
    monkeypatch.setattr(FC, "stored_for_fit", lambda df, own=FC.stored_for_fit: fitted.append(own(df)) or fitted[0])
    zero = {k: np.where(np.arange(len(y)) % 11 == 0, y, 0) for k, y in sparse.items()}
    got = FC.forecast_pooled_gbt(_weekly(spark, zero), 2, max_iter=2).collect()
    long = {k: y for k, y in zero.items() if len(y) >= 18}
    assert {r.channel_id for r in got} == set(long) and len(got) == 2 * len(long)
    assert fitted[0].count() < 0.8 * sum(len(y) - 8 for y in long.values())


def test_split_points():
    assert FC.split_points(np.array([3.0, 1.0, 1.0, 2.0]), 4) == [1.5, 2.5]
    # two rows more are expected, of 0
    assert FC.split_points(np.array([-1.0, 2.0]), 4) == [-0.5, 1.0]
    assert FC.split_points(np.full(5, 7.0), 5) == []
    assert len(FC.split_points(np.arange(1.0, 1001.0), 1000)) == FC.TREE_BINS - 1


def test_anchors_spread_over_buckets():
    """anchors have the least hash of many, so by its first bits nearly all of them came into a few buckets."""
    data = np.random.default_rng(1).integers(97, 123, 200_000).astype(np.uint8)
    _, h = suffix_dedup.anchors(data, np.array([len(data)]))
    distinct, first, inverse = suffix_dedup._cells(h, 6)
    sizes = np.diff(first)
    assert len(distinct) == sizes.sum() == len(np.unique(h)) and sizes.min() > sizes.mean() / 2 and sizes.max() < 2 * sizes.mean()
    assert np.array_equal(np.unique(h, return_inverse=True)[1][:50] == np.unique(h, return_inverse=True)[1][0], inverse[:50] == inverse[0])
