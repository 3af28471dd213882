"""Registered queries: per-creator forecasts and isolation-forest anomalies. The sums
that the forecasts rest on are checked with SQL; the fits themselves are not
expressible in it."""

from __future__ import annotations

from itertools import combinations_with_replacement as pairs

from pyspark.sql import functions as F

from reachlens.operators import anomaly as AN
from reachlens.operators import forecast as FC
from reachlens.operators import timeseries as TS
from reachlens.plans.catalog_cohorts import _SERIES
from reachlens.plans.oracle import with_adapter
from reachlens.plans.registry import register
from reachlens.sources import adapters as A

STEPS = 12
HOLDOUT_STEPS = 8


def _series(spark, sf_dir):
    return TS.weekly_series(A.videos(spark, sf_dir))


@register("t2_arima_forecast")
def t2(spark, sf_dir):
    return FC.forecast_series(_series(spark, sf_dir), STEPS, models=("arima",))


_LAGS = [f"l{k}" for k in range(FC.SEASON + 1)]
_LAG_SQL = ", ".join(f"LAG(views, {k}) OVER (PARTITION BY channel_id ORDER BY week_end) AS l{k}" for k in range(FC.SEASON + 1))


@register("t2_ar_moments", with_adapter(f"""
SELECT channel_id, COUNT(*) AS n,
       {", ".join(f"SUM({a}::DOUBLE) FILTER (r >= {FC.SEASON}) AS s{i}" for i, a in enumerate(_LAGS))},
       {", ".join(f"SUM({a}::DOUBLE * {b}) FILTER (r >= {FC.SEASON}) AS p{i}" for i, (a, b) in enumerate(pairs(_LAGS, 2)))}
FROM (SELECT channel_id, ROW_NUMBER() OVER (PARTITION BY channel_id ORDER BY week_end) - 1 AS r, {_LAG_SQL} FROM ser)
GROUP BY channel_id""", _SERIES))
def t2_moments(spark, sf_dir):
    m, last = FC.ar_moments(_series(spark, sf_dir)), FC.SEASON
    return m.select("channel_id", "n", *[F.col(f"s_{last}")[i].alias(f"s{i}") for i in range(last + 1)],
                    *[F.col(f"p_{last}")[i].alias(f"p{i}") for i, _ in enumerate(pairs(_LAGS, 2))])


@register("t3_holt_winters_forecast")
def t3(spark, sf_dir):
    return FC.forecast_series(_series(spark, sf_dir), STEPS, models=("holt_winters",))


@register("t4_trend_seasonal_forecast")
def t4(spark, sf_dir):
    return FC.forecast_series(_series(spark, sf_dir), STEPS, models=("trend_seasonal",))


_REACH = "(GREATEST(FLOOR(0.8::DOUBLE * n), 1) - 1)"
_BASIS_SQL = ["1", "t", *[f"CASE WHEN n > 3 THEN GREATEST(t - {_REACH} * {j} / {FC.HINGES + 1}.0::DOUBLE, 0) ELSE 0 END" for j in range(1, FC.HINGES + 1)],
              *[f"{f}(t * 2 * pi() * {k} / {FC.YEAR_WEEKS}::DOUBLE)" for k in range(1, FC.FOURIER + 1) for f in ("sin", "cos")]]


@register("t4_trend_moments", with_adapter(f"""
SELECT channel_id, n, SUM(views::DOUBLE * views) AS yy, {", ".join(f"SUM(views * ({x})) AS xy{i}" for i, x in enumerate(_BASIS_SQL))}
FROM (SELECT channel_id, views, week_idx::DOUBLE AS t, COUNT(*) OVER (PARTITION BY channel_id) AS n FROM ser) GROUP BY channel_id, n""", _SERIES),
          round_cols={"yy": 0, **{f"xy{i}": 2 for i in range(len(_BASIS_SQL))}})
def t4_moments(spark, sf_dir):
    m = FC.trend_moments(_series(spark, sf_dir))
    return m.select("channel_id", "n", "yy", *[F.col("xy")[i].alias(f"xy{i}") for i in range(len(_BASIS_SQL))])


@register("t5_pooled_gbt_forecast")
def t5(spark, sf_dir):
    return FC.forecast_pooled_gbt(_series(spark, sf_dir), STEPS)


@register("t6_forecast_comparison")
def t6(spark, sf_dir):
    return FC.compare_forecasts(_series(spark, sf_dir), HOLDOUT_STEPS)


@register("m15_isolation_forest")
def m15(spark, sf_dir):
    z = AN.z_anomalies(A.videos(spark, sf_dir))
    return AN.isolation_forest(z.select("video_id", "views", "engagement_rate"), ["views", "engagement_rate"],
                               "video_id")


@register("m16_anomaly_flags")
def m16(spark, sf_dir):
    return AN.detect_anomalies(A.videos(spark, sf_dir)).select(
        "video_id", "channel_id", "z_views", "z_eng", "z_anomaly", "if_anomaly", "is_anomaly", "anomaly_type",
        "anomaly_score")
