"""Per-creator weekly forecasts for every series in one job.

Series are one row per creator and week, so a series holds at most the number
of weeks in the data's time span. Spark reduces each series to sums: the
autoregression to its lag cross products, trend and seasonality to the products
of the views with a basis that all series of one length share. Only the small
linear systems are solved in Python, many series at once. Holt-Winters is a fold
over the sorted weekly values. The pooled autoregressive model is one
``GBTRegressor`` trained on lag windows of all series, then rolled forward with
one DataFrame pass per step.

Output (long): entity, model, step, week_end, forecast, lower, upper, trend,
seasonal (the last two only for the trend + seasonality model).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations_with_replacement as pairs

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachlens.session import ensure_checkpoint_dir, fit_partitions, materialize, shuffle_partitions, stored_for_fit

SEASON = 4
YEAR_WEEKS = 52.1775
Z80, Z95 = 1.2815515655446004, 1.959963984540054


def _long(fitted: DataFrame, entity: str, model: str) -> DataFrame:
    """One row a step from arrays f, lo, hi, tr, se by step and the last week."""
    step = F.col("_k") + 1
    at = {c: F.get(F.col(c), F.col("_k")) for c in ("f", "lo", "hi", "tr", "se")}
    return fitted.select("*", F.explode(F.sequence(F.lit(0), F.size("f") - 1)).alias("_k")).select(
        entity, F.lit(model).alias("model"), step.cast("int").alias("step"), F.date_add("last_week", 7 * step).alias("week_end"),
        at["f"].alias("forecast"), at["lo"].alias("lower"), at["hi"].alias("upper"), at["tr"].alias("trend"), at["se"].alias("seasonal"))


_NONE = "CAST(NULL AS ARRAY<DOUBLE>)"
_FITTED = "last_week date, f array<double>, lo array<double>, hi array<double>, tr array<double>, se array<double>"


def _solved(moments: DataFrame, entity: str, solve, steps: int) -> DataFrame:
    """``solve(pdf, steps)`` -> f, lo, hi[, tr, se], each (series x steps), over batches of moments."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                parts = [list(x) for x in solve(pdf, steps)]
                parts += [[None] * len(pdf)] * (5 - len(parts))
                yield pd.DataFrame({entity: pdf[entity], "last_week": pdf["last_week"], **dict(zip(("f", "lo", "hi", "tr", "se"), parts))})

    kind = moments.schema[entity].dataType.simpleString()
    # few bytes but much CPU a series: not left to coalescing by size
    moments = moments.repartition(shuffle_partitions(moments.sparkSession), entity)
    return moments.mapInPandas(run, f"`{entity}` {kind}, {_FITTED}")


def packed(series: DataFrame, entity: str = "channel_id") -> DataFrame:
    """One row per series: ``n``, ``last_week`` and ``w``, its weeks with another value than 0 in order (``i``, ``v``).

    Weeks of 0 are counted where they are and neither shuffled nor sorted. NULL is an entity. A packed frame stays as it is."""
    if {"n", "last_week", "w"} <= set(series.columns):
        return series
    v = F.col("views").cast("double")
    seen = series.where(v != 0).select(entity, F.struct(F.col("week_idx").alias("i"), v.alias("v")).alias("_x"),
                                       F.lit(None).cast("long").alias("n"), F.lit(None).cast("date").alias("last_week"))
    ends = series.groupBy(entity).agg(F.count(F.lit(1)).alias("n"), F.max("week_end").alias("last_week"))
    every = seen.unionByName(ends.withColumn("_x", F.lit(None).cast(seen.schema["_x"].dataType)))
    return every.groupBy(entity).agg(F.max("n").alias("n"), F.max("last_week").alias("last_week"), F.sort_array(F.collect_list("_x")).alias("w"))


def weekly_values(w: Column, n: Column) -> Column:
    """The array of all ``n`` weekly values from those that ``packed`` keeps."""
    def zeros(k: Column) -> Column:
        return F.array_repeat(F.lit(0.0), k.cast("int"))

    own = F.transform(w, lambda x, p: F.concat(F.array(x["v"]), zeros(F.coalesce(F.get(w, p + 1)["i"], n) - x["i"] - 1)))
    return F.concat(zeros(F.coalesce(F.get(w, F.lit(0))["i"], n)), F.flatten(own))


# Autoregression -----------------------------------------------------------
#: Orders tried: lags 1..p, with or without the seasonal lag.
AR_ORDERS = [(*range(1, p + 1), *((SEASON,) if s and SEASON > p else ())) for p in range(4) for s in (0, 1)]


def ar_moments(series: DataFrame, entity: str = "channel_id") -> DataFrame:
    """One row per series: ``n``, ``last_week``, ``tail`` (its last SEASON values, latest first, NULL before its start) and
    for every m in 0..SEASON, over the weeks from the m-th on, ``s_m`` (sums of the value and its lags up to m) and
    ``p_m`` (sums of their products, pairs in order). Every order's normal equations are parts of these."""
    def near(k: int) -> Column:
        """The value ``k`` weeks before, which is one of the ``k`` kept before, or 0."""
        found = F.lit(0.0)
        for j in range(1, k + 1):
            before = F.get("w", F.col("_p") - j)
            found = F.when(before["i"] == F.col("i") - k, before["v"]).otherwise(found)
        return found

    rows = packed(series, entity).select(entity, "n", "last_week", "w", F.posexplode_outer("w").alias("_p", "_x")) \
        .select("*", F.col("_x.i").alias("i"), F.col("_x.v").alias("v")) \
        .select(entity, "n", "last_week", "i", "v", (F.col("v") * F.col("v")).alias("q0"), *[(F.col("v") * near(k)).alias(f"q{k}") for k in range(1, SEASON + 1)])
    n, i = F.col("n"), F.col("i")

    def total(x: Column, m: int, a: int) -> Column:
        """Over the weeks from the m-th on, of ``x`` taken a weeks before; NULL without such weeks."""
        return F.when(F.first(n) > m, F.coalesce(F.sum(F.when((i >= m - a) & (i < n - a), x)), F.lit(0.0)))

    out = []
    for m in range(SEASON + 1):
        out += [F.array(*[total(F.col("v"), m, a) for a in range(m + 1)]).alias(f"s_{m}"),
                F.array(*[total(F.col(f"q{b - a}"), m, a) for a, b in pairs(range(m + 1), 2)]).alias(f"p_{m}")]
    tail = [F.when(F.first(n) > k, F.coalesce(F.sum(F.when(i == n - 1 - k, F.col("v"))), F.lit(0.0))) for k in range(SEASON)]
    return rows.groupBy(entity).agg(F.first("n").alias("n"), F.first("last_week").alias("last_week"), *out, F.array(*tail).alias("tail"))


def _centred(pdf: pd.DataFrame, m: int, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and centred cross products of the value and its lags up to m."""
    def stack(column: str, width: int) -> np.ndarray:
        return np.nan_to_num(np.array(pdf[column].tolist(), float).reshape(len(pdf), width)).astype(np.longdouble)

    s = stack(f"s_{m}", m + 1)
    p = stack(f"p_{m}", (m + 1) * (m + 2) // 2)
    full = np.zeros((len(pdf), m + 1, m + 1), np.longdouble)
    for k, (i, j) in enumerate(pairs(range(m + 1), 2)):
        full[:, i, j] = full[:, j, i] = p[:, k]
    mean = s / np.maximum(size, 1)[:, None]
    centred = full - mean[:, :, None] * s[:, None, :]
    # a value that never varies has no spread but rounding
    flat = np.einsum("nii->ni", centred) <= 1e-14 * np.einsum("nii->ni", full)
    centred[flat[:, :, None] | flat[:, None, :]] = 0
    return mean.astype(float), centred.astype(float)


def _solve_ar(pdf: pd.DataFrame, steps: int):
    """Least squares of every order from the moments, the best by AIC, recursive forecast, normal interval whose variance
    grows with the horizon. Lags that never vary get no weight; without enough weeks the last value goes on."""
    n, size = pdf["n"].to_numpy(), len(pdf)
    aic, sigma2 = np.full(size, np.inf), np.zeros(size)
    beta = np.zeros((size, SEASON + 1))
    tail = np.array([[0.0 if v is None else v for v in x] for x in pdf["tail"]], float).reshape(size, SEASON)
    tail = np.nan_to_num(tail)
    moments = {m: _centred(pdf, m, n - m) for m in range(SEASON + 1)}
    for lags in AR_ORDERS:
        m = max(lags, default=0)
        mean, c = moments[m]
        rows = n - m
        at = list(lags)
        own, cross = c[:, at][:, :, at], c[:, at, 0]
        scale = np.sqrt(np.einsum("nii->ni", own))
        scale[scale == 0] = 1
        b = np.einsum("nij,nj->ni", np.linalg.pinv(own / scale[:, :, None] / scale[:, None, :], rcond=1e-10, hermitian=True), cross / scale) / scale if at else np.zeros((size, 0))
        rss = c[:, 0, 0] - 2 * np.einsum("ni,ni->n", b, cross) + np.einsum("ni,nij,nj->n", b, own, b)
        var = np.maximum(rss / np.maximum(rows, 1), 1e-12)
        score = np.where(rows >= len(at) + 3, rows * np.log(var) + 2 * (len(at) + 1), np.inf)
        better = score < aic
        aic[better], sigma2[better] = score[better], var[better]
        new = np.zeros((size, SEASON + 1))
        new[:, 0] = mean[:, 0] - np.einsum("ni,ni->n", b, mean[:, at])
        new[:, at] = b
        beta[better] = new[better]
    out, past = np.zeros((size, steps)), tail.copy()
    for h in range(steps):
        out[:, h] = beta[:, 0] + np.einsum("nk,nk->n", beta[:, 1:], past)
        past = np.column_stack([out[:, h], past[:, :-1]])
    none = np.isinf(aic)
    out[none] = tail[none, :1]
    half = Z95 * np.sqrt(sigma2[:, None] * np.arange(1, steps + 1))
    half[none] = 0
    return out, out - half, out + half


# Holt-Winters -------------------------------------------------------------
#: Smoothing constants (level, trend, season) tried.
HW_GRID = [(a, b, g) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.05, 0.2, 0.5) for g in (0.05, 0.3, 0.6)]
#: Weeks in one compiled method; long methods are not compiled to machine code.
_WEEKS_AT_ONCE = 10


def holt_winters(series: DataFrame, steps: int, entity: str = "channel_id") -> DataFrame:
    """Additive trend and seasonality of SEASON weeks; the grid point with the least one-step error forecasts; band +-20 %.
    Under two seasons of data the last value goes on.

    A row for each series and grid point holds level, trend, seasonal terms and squared error; a week is one projection
    over it, so that the recurrence is compiled. There are as many projections as the longest series has weeks."""
    ensure_checkpoint_dir(series.sparkSession)
    # the work is CPU by series, not bytes: a given number of partitions, which adaptive execution leaves as it is
    spread = packed(series, entity).repartition(shuffle_partitions(series.sparkSession), entity)
    y = spread.select(entity, "last_week", F.col("n").cast("int").alias("n"), weekly_values(F.col("w"), F.col("n")).alias("_y")).checkpoint()
    longest = y.agg(F.max("n")).first()[0] or 0

    def mean(first: int) -> Column:
        return sum((F.get("_y", F.lit(first + k)) for k in range(1, SEASON)), F.get("_y", F.lit(first))) / SEASON

    seasons = [f"s{k}" for k in range(SEASON)]
    # error correction form: the next level, trend and season move by these shares of the one-step error
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a + a * b).alias("ga"), F.lit(a * b).alias("gb"), F.lit(g * (1 - a)).alias("gs"))
                     for i, (a, b, g) in enumerate(HW_GRID)])
    x = y.where(F.col("n") >= 2 * SEASON).withColumn("_m", mean(0)).withColumn("trend", (mean(SEASON) - F.col("_m")) / SEASON) \
        .select(entity, "last_week", "n", "_y", (F.col("_m") + F.col("trend")).alias("next"), "trend",
                *[(F.get("_y", F.lit(k)) - F.col("_m")).alias(s) for k, s in enumerate(seasons)], F.lit(0.0).alias("sse"), F.inline(grid))
    state = ["next", "trend", "sse", *seasons]
    kept = [f"`{c}`" for c in x.columns if c not in state]
    for t in range(SEASON, longest):
        own = seasons[t % SEASON]
        # weeks after a series' last only carry its trend on
        err = f"if({t} < n, get(_y, {t}) - (next + {own}), 0D)"
        moved = {"next": f"next + trend + ga * {err}", "trend": f"trend + gb * {err}", "sse": f"sse + {err} * {err}", own: f"{own} + gs * {err}"}
        x = x.selectExpr(*kept, *[f"{moved.get(c, c)} AS {c}" for c in state])
        if (t - SEASON) % _WEEKS_AT_ONCE == _WEEKS_AT_ONCE - 1:
            x = x.coalesce(1 << 30)  # no fewer partitions, but an end to the compiled method
    ends = F.struct("sse", "i", "next", "trend", *seasons)
    best = x.groupBy(entity, "n", "last_week").agg(F.min(ends).alias("_b"))
    steps_ahead = F.sequence(F.lit(1), F.lit(steps))
    behind = F.greatest(F.lit(longest), F.col("n")) - F.col("n")
    ahead = best.select(entity, "last_week", F.transform(steps_ahead, lambda h: F.col("_b.next") + (h - 1 - behind) * F.col("_b.trend") + F.get(
        F.array(*[F.col(f"_b.{s}") for s in seasons]), (F.col("n") + h - 1) % SEASON)).alias("f"))
    short = y.where(F.col("n") < 2 * SEASON).select(entity, "last_week", F.array_repeat(F.element_at("_y", -1), steps).alias("f"))
    return ahead.unionByName(short).select(
        entity, "last_week", "f", F.transform("f", lambda v: v - 0.2 * F.abs(v)).alias("lo"), F.transform("f", lambda v: v + 0.2 * F.abs(v)).alias("hi"),
        F.expr(_NONE).alias("tr"), F.expr(_NONE).alias("se"))


# T4: trend and seasonality ----------------------------------------------------
HINGES, FOURIER, RIDGE = 8, 3, 1.0
_BASIS = 2 + HINGES + 2 * FOURIER


def trend_basis(t: Column, n: Column) -> list[Column]:
    """Terms at week ``t`` of a series of ``n`` weeks: constant, slope, hinges at even quantiles of the first 80 % of the
    weeks (none up to three weeks), and yearly sines and cosines."""
    t = t.cast("double")
    reach = F.greatest(F.floor(F.lit(0.8) * n), F.lit(1)) - 1
    hinge = [F.when(n > 3, F.greatest(t - reach * F.lit(j / (HINGES + 1)), F.lit(0.0))).otherwise(F.lit(0.0)) for j in range(1, HINGES + 1)]
    wave = [f(t * F.lit(2 * np.pi * k / YEAR_WEEKS)) for k in range(1, FOURIER + 1) for f in (F.sin, F.cos)]
    return [F.lit(1.0), t, *hinge, *wave]


def trend_moments(series: DataFrame, entity: str = "channel_id") -> DataFrame:
    """One row per series: ``n``, ``last_week``, ``yy`` (sum of squares), ``xy`` (products with the basis) and ``xx``
    (products of the basis, pairs in order), which all series of one length share."""
    rows = packed(series, entity).select(entity, "n", "last_week", F.explode_outer("w").alias("_x"))
    i, y = F.col("_x.i"), F.col("_x.v")

    def total(x: Column) -> Column:
        return F.coalesce(F.sum(x), F.lit(0.0))

    own = rows.groupBy(entity).agg(F.first("n").alias("n"), F.first("last_week").alias("last_week"), total(y * y).alias("yy"),
                                   F.array(*[total(y * x) for x in trend_basis(i, F.col("n"))]).alias("xy"))
    weeks = own.select("n").distinct().select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("_t"))
    weeks = weeks.select("n", *[x.alias(f"x{i}") for i, x in enumerate(trend_basis(F.col("_t"), F.col("n")))])
    shared = weeks.groupBy("n").agg(F.array(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs(range(_BASIS), 2)]).alias("xx"))
    return own.join(shared, "n")


def _solve_trend(pdf: pd.DataFrame, steps: int):
    """Ridge on all but constant and slope; 80 % interval from the residual spread; trend and seasonal parts."""
    n = pdf["n"].to_numpy()
    xy, yy = np.stack(pdf["xy"].to_numpy()), pdf["yy"].to_numpy()
    f, trend, sd = np.zeros((len(pdf), steps)), np.zeros((len(pdf), steps)), np.zeros(len(pdf))
    for size in np.unique(n):
        at = np.flatnonzero(n == size)
        gram = np.zeros((_BASIS, _BASIS))
        for v, (i, j) in zip(pdf["xx"].iloc[at[0]], pairs(range(_BASIS), 2)):
            gram[i, j] = gram[j, i] = v
        beta = np.linalg.lstsq(gram + np.diag([0.0, 0.0] + [RIDGE] * (_BASIS - 2)), xy[at].T, rcond=None)[0]
        rss = yy[at] - 2 * np.einsum("in,ni->n", beta, xy[at]) + np.einsum("in,ij,jn->n", beta, gram, beta)
        sd[at] = np.sqrt(np.maximum(rss, 0) / max(size - 1, 1))
        t = size - 1 + np.arange(1, steps + 1)
        reach = max(int(0.8 * size), 1) - 1
        hinge = [np.maximum(t - reach * (j / (HINGES + 1)), 0.0) if size > 3 else np.zeros(steps) for j in range(1, HINGES + 1)]
        wave = [g(t * (2 * np.pi * k / YEAR_WEEKS)) for k in range(1, FOURIER + 1) for g in (np.sin, np.cos)]
        ahead = np.array([np.ones(steps), t, *hinge, *wave])
        f[at] = beta.T @ ahead
        trend[at] = beta[:2 + HINGES].T @ ahead[:2 + HINGES]
    half = Z80 * sd[:, None]
    return f, f - half, f + half, trend, f - trend


def forecast_series(series: DataFrame, steps: int = 12, entity: str = "channel_id",
                    models: tuple[str, ...] = ("arima", "holt_winters", "trend_seasonal")) -> DataFrame:
    """The per-series models for every entity (T2 ``arima``, T3 ``holt_winters``, T4 ``trend_seasonal``).

    ``series`` is as from ``weekly_series``: one row a week without gaps,
    ``week_idx`` from 0; or as from ``packed``."""
    fits = {"arima": lambda: _solved(ar_moments(series, entity), entity, _solve_ar, steps),
            "holt_winters": lambda: holt_winters(series, steps, entity),
            "trend_seasonal": lambda: _solved(trend_moments(series, entity), entity, _solve_trend, steps)}
    return reduce(DataFrame.unionByName, [_long(fits[m](), entity, m) for m in models])


# T5: pooled boosted-tree autoregression ---------------------------------------
#: What Spark's trees take by default: bins of a feature, and rows that the bounds of bins are found from.
TREE_BINS, SPLIT_ROWS = 32, 10_000


def split_points(values: np.ndarray, rows: float, bins: int = TREE_BINS) -> list[float]:
    """The bounds between a feature's bins, as Spark's trees take them from a sample in which ``rows`` are expected: halfway
    between distinct values, all of them or those nearest to even shares. Rows that are missing count as 0."""
    found, counts = np.unique(values[values != 0], return_counts=True)
    if rows - counts.sum() > np.finfo(float).eps * 100 * max(counts.sum(), 1):
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts.astype(float), at, rows - counts.sum())
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) < bins:
        return middle.tolist()
    out, target, upto = [], rows / bins, np.cumsum(counts)
    for k in range(1, len(found)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            out.append(float(middle[k - 1]))
            target += rows / bins
    return out


def binned_windows(win: DataFrame, rows: int, lag_cols: list[str], label: str, seed: int) -> tuple[DataFrame, Bucketizer]:
    """One row for each combination of bins that windows have: the bins' numbers from 1 (under the lags' names), how many
    windows (``_k``) and their mean label. Trees see no more of a window than its bins, so a fit by weight is the same as
    one of all windows. Also what finds the bins. The bounds are those that a fit of ``win`` itself would take."""
    spark = win.sparkSession
    share = min(1.0, SPLIT_ROWS / max(rows, 1))
    # the sampler that Spark's trees use, with the seed that they draw from theirs, on the partitions of a stored frame
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    lags = win.select(*lag_cols).coalesce(fit_partitions(spark, rows))
    some = DataFrame(spark._jsparkSession.createDataFrame(lags._jdf.toJavaRDD().sample(False, share, draw), lags._jdf.schema()), spark).toPandas()
    bounds = [split_points(some[c].to_numpy(float), share * rows) for c in lag_cols]
    # a value at a bound belongs below it, which Bucketizer has otherwise; without bounds all are in one bin
    splits = [[-np.inf, *(np.nextafter(x, np.inf).tolist() if x else [np.finfo(float).max]), np.inf] for x in bounds]
    bins = Bucketizer(splitsArray=splits, inputCols=lag_cols, outputCols=[f"_b{c}" for c in lag_cols])
    own = in_bins(bins, win, lag_cols, label).groupBy(*lag_cols).agg(F.count(F.lit(1)).cast("double").alias("_k"), F.avg(label).alias(label))
    return own, bins


def in_bins(bins: Bucketizer, win: DataFrame, lag_cols: list[str], *kept: str) -> DataFrame:
    # numbers from 1: to Spark's trees 0 is what a sample left out
    return bins.transform(win).select(*kept, *[(F.col(f"_b{c}") + 1).alias(c) for c in lag_cols])


def forecast_pooled_gbt(series: DataFrame, steps: int = 12, lookback: int = 8, entity: str = "channel_id",
                        min_windows: int = 10, max_iter: int = 50, seed: int = 42) -> DataFrame:
    """One boosted-tree model on standardised lag windows of all series;
    forecasts roll forward one step per DataFrame pass. Series with fewer
    than ``min_windows`` windows get no forecast.

    The windows are neither stored nor fitted one by one but counted by their bins (``binned_windows``), of which
    series with many weeks of 0 have few. Without such weeks there may be as many as windows."""
    stats = series.groupBy(entity).agg(F.avg("views").alias("_mu"), (F.stddev_pop("views") + F.lit(1e-8)).alias("_sd"))
    # one row a series: its weeks are an array, bounded by the time span, which windows are cut from
    own = packed(series, entity).where(F.col("n") >= lookback + min_windows).join(stats, entity)
    own = own.select(entity, "_mu", "_sd", F.col("last_week").alias("_last_week"), "n", "w").checkpoint()
    rows = own.agg(F.sum(F.col("n") - lookback)).first()[0] or 0
    own = own.select(entity, "_mu", "_sd", "_last_week", F.transform(weekly_values(F.col("w"), F.col("n")), lambda v: (v - F.col("_mu")) / F.col("_sd")).alias("_z"))
    lag_cols = [f"lag{k}" for k in range(lookback, 0, -1)]
    win = own.select("_z", F.explode(F.sequence(F.lit(0), F.size("_z") - lookback - 1)).alias("_i")) \
        .select(*[F.get("_z", F.col("_i") + k).alias(c) for k, c in enumerate(lag_cols)], F.get("_z", F.col("_i") + lookback).alias("_z"))
    counted, bins = binned_windows(win, rows, lag_cols, "_z", seed)
    asm = VectorAssembler(inputCols=lag_cols, outputCol="features")
    # bins enough, and so rows for their bounds, that each number is one
    model = GBTRegressor(featuresCol="features", labelCol="_z", weightCol="_k", maxIter=max_iter, maxDepth=4, stepSize=0.1, maxBins=1 << 10,
                         seed=seed).fit(stored_for_fit(asm.transform(counted).select("features", "_z", "_k")))
    state = own.select(entity, "_mu", "_sd", "_last_week", F.slice("_z", -lookback, lookback).alias("_win"))
    preds = None
    for h in range(1, steps + 1):
        feats = state.select("*", *[F.col("_win")[i].alias(c) for i, c in enumerate(lag_cols)])
        p = model.transform(asm.transform(in_bins(bins, feats, lag_cols, entity, "_mu", "_sd", "_last_week", "_win"))).select(entity, "_mu", "_sd", "_last_week", "_win", "prediction").checkpoint()
        step = p.select(entity, F.lit("pooled_gbt").alias("model"), F.lit(h).alias("step"),
                        F.date_add("_last_week", 7 * h).alias("week_end"),
                        (F.col("prediction") * F.col("_sd") + F.col("_mu")).alias("forecast"))
        preds = step if preds is None else preds.unionByName(step)
        state = p.select(entity, "_mu", "_sd", "_last_week",
                         F.slice(F.concat("_win", F.array("prediction")), 2, lookback).alias("_win"))
    return preds.select(entity, "model", "step", "week_end", "forecast",
                        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"),
                        F.lit(None).cast("double").alias("trend"), F.lit(None).cast("double").alias("seasonal"))


# T6 --------------------------------------------------------------------------
def compare_forecasts(series: DataFrame, steps: int = 8, train_share: float = 0.8, entity: str = "channel_id",
                      include_pooled: bool = True, max_iter: int = 50) -> DataFrame:
    """Single hold-out comparison: fit on the first floor(n*share) weeks,
    score the next min(steps, n - split) weeks: MAPE on value+1 and RMSE per
    entity and model."""
    # one row a series, stored: models and scores read its weeks before and after the split
    own = materialize(packed(series, entity).where(F.col(entity).isNotNull()).withColumn("_split", F.floor(F.col("n") * train_share)), "packed-series")
    train = own.where("_split > 0").select(
        entity, F.col("_split").alias("n"), F.expr("date_sub(last_week, cast(7 * (n - _split) AS int))").alias("last_week"),
        F.filter("w", lambda x: x["i"] < F.col("_split")).alias("w"))
    ahead = F.slice(weekly_values(F.col("w"), F.col("n")), F.col("_split").cast("int") + 1, F.lit(steps))
    test = own.select(entity, F.posexplode(ahead).alias("_p", "_a")).select(entity, (F.col("_p") + 1).alias("step"), "_a")
    # a model's forecasts are stored before the next is planned: one plan of them all does not fit the driver
    fits = [lambda m=m: forecast_series(train, steps, entity, (m,)) for m in ("arima", "holt_winters", "trend_seasonal")]
    if include_pooled:
        n = series.groupBy(entity).agg(F.count(F.lit(1)).alias("_n"))
        weeks = series.join(n, entity).where(F.col("week_idx") < F.floor(F.col("_n") * train_share)).select(entity, "week_end", "week_idx", "views")
        fits.append(lambda: forecast_pooled_gbt(weeks, steps, entity=entity, max_iter=max_iter))
    fc = [materialize(fit().select(entity, "model", "step", "forecast"), "forecasts") for fit in fits]
    j = reduce(DataFrame.unionByName, fc).join(test, [entity, "step"])
    err = F.col("_a") - F.col("forecast")
    return j.groupBy(entity, "model").agg(F.avg(F.abs(err) / (F.col("_a") + 1)).alias("mape"),
                                          F.sqrt(F.avg(err * err)).alias("rmse"),
                                          F.count(F.lit(1)).alias("n_test"))
