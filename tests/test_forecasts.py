"""Distributed forecasters against one series at a time."""

import datetime as dt

import numpy as np
import pytest

from reachlens.operators import forecast as FC
from tests import plain_forecasts as plain

STEPS = 6


@pytest.fixture(scope="module")
def weekly(spark):
    rng = np.random.default_rng(11)
    out = {}
    for k in range(60):
        n = int(rng.integers(1, 90)) if k > 12 else k + 1
        level = np.cumsum(rng.normal(0, 300, n)) + 5000 + 800 * np.sin(np.arange(n) * np.pi / 2)
        out[k] = np.maximum(level + rng.normal(0, 500, n), 0).astype(int)
    out[100] = np.full(30, 7)
    out[101] = np.zeros(20, int)
    rows = [(k, dt.date(2020, 1, 5) + dt.timedelta(days=7 * i), i, int(v)) for k, y in out.items() for i, v in enumerate(y)]
    return out, spark.createDataFrame(rows, "channel_id long, week_end date, week_idx int, views long").repartition(5)


@pytest.fixture(scope="module")
def got(weekly):
    out = {}
    for r in FC.forecast_series(weekly[1], STEPS).orderBy("step").collect():
        out.setdefault((r.channel_id, r.model), []).append(r)
    return out


@pytest.mark.parametrize("model", ["arima", "holt_winters", "trend_seasonal"])
def test_same_as_one_series_at_a_time(weekly, got, model):
    series, _ = weekly
    for k, y in series.items():
        y = y.astype(float)
        if model == "arima":
            want = (*plain.fit_ar(y, STEPS), None, None)
        elif model == "holt_winters":
            want = (*plain.fit_holt_winters(y, STEPS), None, None)
        else:
            want = plain.fit_trend_seasonal(np.arange(len(y), dtype=float), y, STEPS)
        rows = got[k, model]
        assert [r.step for r in rows] == list(range(1, STEPS + 1))
        last = dt.date(2020, 1, 5) + dt.timedelta(days=7 * (len(y) - 1))
        assert [r.week_end for r in rows] == [last + dt.timedelta(days=7 * h) for h in range(1, STEPS + 1)]
        size = max(np.abs(y).max(), 1)
        for column, values in zip(("forecast", "lower", "upper", "trend", "seasonal"), want):
            own = [getattr(r, column) for r in rows]
            if values is None:
                assert own == [None] * STEPS
            else:
                # a fit without residuals leaves rounding only
                near = 1e-6 if column in ("forecast", "trend", "seasonal") else 1e-4
                assert np.allclose(own, values, rtol=1e-6, atol=near * size), (k, column, own, values)


def test_holt_winters_band_and_plan(weekly):
    f = FC.forecast_series(weekly[1], STEPS, models=("holt_winters",))
    assert f.where("lower > upper").count() == 0
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_series_without_rows(weekly):
    assert FC.forecast_series(weekly[1].limit(0), STEPS).collect() == []
