"""Causal estimators.

Estimators reduce the data to sufficient statistics with aggregates (two
passes where centring matters numerically) and finish with column
arithmetic, so the heavy part is a distributed ``groupBy``/``agg``. p-values
come from the small ``numerics`` helpers applied to one row per test.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachlens.functions import columns as C
from reachlens.functions.numerics import norm_ppf, t_ppf, t_pvalue_udf, t_sf_two_sided
from reachlens.operators.quantiles import exact_percentiles


# A27 / A28 -------------------------------------------------------------------
def pre_post_means(videos: DataFrame, entity: str = "channel_id", ts: str = "publish_time",
                   measure: str = "views") -> DataFrame:
    """Per entity: mean of ``measure`` before and from the median upload time
    on (the median is exact and interpolated); entities lacking either side
    are dropped."""
    t = videos.select(entity, measure, C.epoch_micros(ts).cast("double").alias("_t"))
    mid = exact_percentiles(t, [], "_t", [0.5], ["_mid"])
    j = t.crossJoin(F.broadcast(mid))
    g = j.groupBy(entity).agg(F.avg(F.when(F.col("_t") < F.col("_mid"), F.col(measure))).alias("pre_views"),
                              F.avg(F.when(F.col("_t") >= F.col("_mid"), F.col(measure))).alias("post_views"))
    # one row per entity, read by the quantile and every estimator above: stored once
    return g.dropna(subset=["pre_views", "post_views"]).checkpoint()


def flag_top_quantile(df: DataFrame, value: str, q: float, flag: str = "treated") -> DataFrame:
    """flag = 1 when value >= its q-quantile over the whole frame, else 0."""
    th = exact_percentiles(df, [], value, [q], ["_th"])
    return df.crossJoin(F.broadcast(th)).withColumn(flag, (F.col(value) >= F.col("_th")).cast("int")).drop("_th")


def flag_members(df: DataFrame, entity: str, members: DataFrame | Sequence, flag: str = "treated") -> DataFrame:
    """flag = 1 for entities in ``members`` (a list, or a frame of keys joined
    with a left semi-style left join so it can be large)."""
    if isinstance(members, DataFrame):
        m = members.select(F.col(entity)).distinct().withColumn("_m", F.lit(1))
        return df.join(m, entity, "left").withColumn(flag, F.coalesce("_m", F.lit(0))).drop("_m")
    return df.withColumn(flag, F.col(entity).isin(list(members)).cast("int"))


# X1 / X2 ---------------------------------------------------------------------
def _centered(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: n and centred sums of squares / cross products of ``cols``
    (two passes: means first, then centred products)."""
    means = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(means))
    prods = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            prods.append(F.sum((F.col(a) - F.col(f"m_{a}")) * (F.col(b) - F.col(f"m_{b}"))).alias(f"S_{a}_{b}"))
    return j.groupBy("n", *[f"m_{c}" for c in cols]).agg(*prods)


def trending_did(prepost: DataFrame, treated: str = "treated", with_p: bool = True) -> DataFrame:
    """Difference in differences of log1p means, plus the covariate-adjusted
    estimate from OLS log_post ~ treated + log_pre (coefficient, standard
    error, t and optionally p of ``treated``)."""
    d = prepost.select(F.col(treated).cast("double").alias("x1"), F.log1p("pre_views").alias("x2"),
                       F.log1p("post_views").alias("y"))
    means = d.agg(
        F.avg(F.when(F.col("x1") == 1, F.col("y"))).alias("tp"), F.avg(F.when(F.col("x1") == 1, F.col("x2"))).alias("tq"),
        F.avg(F.when(F.col("x1") == 0, F.col("y"))).alias("cp"), F.avg(F.when(F.col("x1") == 0, F.col("x2"))).alias("cq"),
        F.count_if(F.col("x1") == 1).alias("treated_count"), F.count_if(F.col("x1") == 0).alias("control_count"))
    s = _centered(d, ["x1", "x2", "y"])
    j = means.crossJoin(s)
    det = F.col("S_x1_x1") * F.col("S_x2_x2") - F.col("S_x1_x2") * F.col("S_x1_x2")
    b1 = F.try_divide(F.col("S_x2_x2") * F.col("S_x1_y") - F.col("S_x1_x2") * F.col("S_x2_y"), det)
    b2 = F.try_divide(F.col("S_x1_x1") * F.col("S_x2_y") - F.col("S_x1_x2") * F.col("S_x1_y"), det)
    rss = F.col("S_y_y") - b1 * F.col("S_x1_y") - b2 * F.col("S_x2_y")
    se = F.sqrt(F.try_divide(F.try_divide(rss, F.col("n") - 3) * F.col("S_x2_x2"), det))
    out = j.select(((F.col("tp") - F.col("tq")) - (F.col("cp") - F.col("cq"))).alias("did_estimate"),
                   "treated_count", "control_count", b1.alias("treated_coef"), se.alias("treated_se"),
                   (F.col("n") - 3).alias("_df"))
    out = out.withColumn("treated_t", F.try_divide("treated_coef", "treated_se"))
    if with_p:
        out = out.withColumn("treated_pval", t_pvalue_udf(F.col("treated_t"), F.col("_df").cast("double")))
    return out.drop("_df")


# X5 / X12 --------------------------------------------------------------------
def pooled_t(m1, m2, v1, v2, n1, n2):
    """Equal-variance two-sample t statistic from means, sample variances, counts."""
    sp2 = F.try_divide((n1 - 1) * v1 + (n2 - 1) * v2, n1 + n2 - 2)
    one = F.lit(1.0)
    return F.try_divide(m1 - m2, F.sqrt(sp2 * (F.try_divide(one, n1) + F.try_divide(one, n2))))


def att_ttest(pairs: DataFrame, treated: str = "treated_views", control: str = "control_views",
              with_p: bool = True) -> DataFrame:
    """ATT = mean(treated - control) over matched pairs, and the
    independent equal-variance t-test of the two columns."""
    a = pairs.agg(F.avg(F.col(treated) - F.col(control)).alias("att"), F.count(F.lit(1)).alias("n_pairs"),
                  F.avg(treated).alias("_m1"), F.avg(control).alias("_m2"),
                  F.var_samp(treated).alias("_v1"), F.var_samp(control).alias("_v2"))
    n = F.col("n_pairs")
    out = a.select("att", "n_pairs", pooled_t(F.col("_m1"), F.col("_m2"), F.col("_v1"), F.col("_v2"), n, n)
                   .alias("t_statistic"))
    if with_p:
        out = out.withColumn("p_value", t_pvalue_udf(F.col("t_statistic"), (2 * F.col("n_pairs") - 2).cast("double")))
    return out


def did_prepost(series: DataFrame, entity: str, period: str, y: str, x: str, cut,
                with_p: bool = True) -> DataFrame:
    """Per entity: (post - pre) - (control_post - control_pre) on the means
    of ``y`` and the control ``x`` split at ``cut``, the lift as % of the pre
    mean, and the t-test of post vs pre values of ``y``."""
    post = F.col(period) >= F.lit(cut)
    g = series.groupBy(entity).agg(
        F.avg(F.when(~post, F.col(y))).alias("pre_mean"), F.avg(F.when(post, F.col(y))).alias("post_mean"),
        F.avg(F.when(~post, F.col(x))).alias("ctrl_pre"), F.avg(F.when(post, F.col(x))).alias("ctrl_post"),
        F.var_samp(F.when(~post, F.col(y))).alias("_v0"), F.var_samp(F.when(post, F.col(y))).alias("_v1"),
        F.count_if(~post).alias("n_pre"), F.count_if(post).alias("n_post"))
    did = (F.col("post_mean") - F.col("pre_mean")) - (F.col("ctrl_post") - F.col("ctrl_pre"))
    out = g.select(entity, "n_pre", "n_post", "pre_mean", "post_mean", "ctrl_pre", "ctrl_post",
                   did.alias("did_estimate"), (F.try_divide(did, F.col("pre_mean")) * 100).alias("pct_lift"),
                   pooled_t(F.col("post_mean"), F.col("pre_mean"), F.col("_v1"), F.col("_v0"),
                            F.col("n_post"), F.col("n_pre")).alias("t_statistic"))
    if with_p:
        out = out.withColumn("p_value", t_pvalue_udf(F.col("t_statistic"),
                                                     (F.col("n_pre") + F.col("n_post") - 2).cast("double")))
    return out


# X11 -------------------------------------------------------------------------
def pre_post_counterfactual(series: DataFrame, entity: str, period: str, y: str, x: str, cut,
                            level: float = 0.95) -> DataFrame:
    """Per entity fit y = a + b*x on periods before ``cut``; for periods from
    ``cut`` on: counterfactual, prediction interval, point effect and
    cumulative effect. A series has one row per period, so the cumulative
    window is bounded by the number of periods."""
    pre = F.col(period) < F.lit(cut)
    fit = series.where(pre).groupBy(entity).agg(
        F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"), F.regr_count(y, x).alias("n_pre"),
        F.regr_avgx(y, x).alias("_xbar"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"),
        F.regr_sxy(y, x).alias("_sxy"))
    fit = fit.withColumn("_s2", F.try_divide(F.col("_syy") - F.col("_b") * F.col("_sxy"), F.col("n_pre") - 2))
    z = norm_ppf(0.5 + level / 2)
    j = series.where(~pre).join(fit, entity)
    yhat = F.col("_a") + F.col("_b") * F.col(x)
    half = F.lit(z) * F.sqrt(F.col("_s2") * (1 + F.try_divide(F.lit(1.0), F.col("n_pre"))
                                             + F.try_divide(F.pow(F.col(x) - F.col("_xbar"), 2), F.col("_sxx"))))
    j = j.select(entity, period, y, x, "n_pre", yhat.alias("counterfactual"),
                 (yhat - half).alias("lower"), (yhat + half).alias("upper"),
                 (F.col(y) - yhat).alias("effect"))
    w = Window.partitionBy(entity).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.withColumn("cum_effect", F.sum("effect").over(w))


def counterfactual_summary(points: DataFrame, entity: str, y: str) -> DataFrame:
    """Per entity: post periods, mean and total effect, relative lift."""
    return points.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_post"), F.avg("effect").alias("avg_effect"),
        F.sum("effect").alias("cum_effect"),
        (F.sum("effect") / F.sum("counterfactual")).alias("relative_lift"))


# X13 -------------------------------------------------------------------------
def ols_table(df: DataFrame, y: str, xs: Sequence[str], level: float = 0.95) -> DataFrame:
    """OLS with intercept: coefficient table (term, coef, std_err, t, p_value,
    ci_low, ci_high) from centred cross products aggregated in Spark; the
    k x k system is solved on the driver with a pseudo-inverse, so exactly
    collinear features get the minimum-norm solution instead of an error."""
    xs = list(xs)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in xs], F.col(y).cast("double").alias("_y")).dropna()
    s = _centered(d, xs + ["_y"]).collect()[0]
    n = s["n"]
    k = len(xs)
    sxx = np.array([[s[f"S_{xs[min(i, j)]}_{xs[max(i, j)]}"] for j in range(k)] for i in range(k)], dtype=float)
    sxy = np.array([s[f"S_{c}__y"] for c in xs], dtype=float)
    inv = np.linalg.pinv(sxx)
    beta = inv @ sxy
    rss = s["S__y__y"] - float(beta @ sxy)
    dof = n - np.linalg.matrix_rank(sxx) - 1
    sigma2 = rss / dof
    xbar = np.array([s[f"m_{c}"] for c in xs], dtype=float)
    b0 = s["m__y"] - float(beta @ xbar)
    var0 = sigma2 * (1.0 / n + float(xbar @ inv @ xbar))
    coefs = [("Intercept", b0, var0)] + [(c, float(beta[i]), sigma2 * inv[i, i]) for i, c in enumerate(xs)]
    q = t_ppf(0.5 + level / 2, dof)
    rows = []
    for term, b, v in coefs:
        se = float(np.sqrt(max(v, 0.0)))
        t = b / se if se > 0 else float("nan")
        rows.append((term, float(b), se, float(t), float(t_sf_two_sided(t, dof)), float(b - q * se), float(b + q * se)))
    return df.sparkSession.createDataFrame(
        rows, "term string, coef double, std_err double, t double, p_value double, ci_low double, ci_high double")
