"""Experiment design and factorial analysis.

Design grids are data-driven: baseline and spread per segment come from one
``groupBy``; the parameter grid (effect sizes x alpha x power) is a small
literal frame whose size is fixed by the caller. Two-way ANOVA reduces the
data to per-cell sufficient statistics (count, sum, sum of squares) in one
pass, so it scales with the number of cells, not rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachlens.functions.numerics import f_pvalue_udf, norm_cdf_udf, norm_ppf


def design_grid(spark, mde_pcts: Sequence[float] = (0.10,), alphas: Sequence[float] = (0.05,),
                powers: Sequence[float] = (0.80,)) -> DataFrame:
    """Parameter grid with the normal quantiles precomputed (one row per combination)."""
    rows = [(float(m), float(a), float(p), norm_ppf(1 - a / 2), norm_ppf(p))
            for m, a, p in product(mde_pcts, alphas, powers)]
    return spark.createDataFrame(rows, "mde_pct double, alpha double, power double, z_alpha double, z_power double")


def sample_size_expr(d, z_alpha, z_power):
    """Per-group n for a two-sample t-test at standardised effect d (normal
    approximation with the small-sample correction z_alpha^2/4)."""
    return F.ceil(2 * F.pow((z_alpha + z_power) / d, 2) + F.pow(z_alpha, 2) / 4)


def power_grid(df: DataFrame, value: str, segment: str | None = None,
               mde_pcts: Sequence[float] = (0.10,), alphas: Sequence[float] = (0.05,),
               powers: Sequence[float] = (0.80,), daily_active: int = 5_000,
               allocation: float = 1.0) -> DataFrame:
    """Sample-size design per segment: baseline = mean, spread = sample std of
    ``value``; for every (mde, alpha, power): Cohen's d, n per group, total n
    and recruitment days at ``daily_active`` * ``allocation`` per day (X6, X8)."""
    keys = [segment] if segment else []
    stats = (df.groupBy(*keys) if keys else df).agg(F.avg(value).alias("baseline"),
                                                    F.stddev_samp(value).alias("std_estimate"))
    grid = design_grid(df.sparkSession, mde_pcts, alphas, powers)
    # the grid has len(mde)*len(alpha)*len(power) rows, fixed by the caller
    j = stats.crossJoin(F.broadcast(grid))
    d = F.try_divide(F.col("baseline") * F.col("mde_pct"), F.col("std_estimate"))
    d = F.when(d != 0, d)  # a constant or zero-mean segment has no design
    n = sample_size_expr(d, F.col("z_alpha"), F.col("z_power")).cast("long")
    j = j.select(*keys, "baseline", "std_estimate", "mde_pct", "alpha", "power",
                 (F.col("baseline") * F.col("mde_pct")).alias("minimum_detectable_effect"),
                 d.alias("cohens_d"), n.alias("n_per_group"))
    j = j.withColumn("total_n", F.col("n_per_group") * 2)
    return j.withColumn("runtime_days",
                        F.ceil(F.col("total_n") / F.lit(float(daily_active * allocation))).cast("long"))


def power_curve(design: DataFrame, effect_sizes: Sequence[float], n_col: str = "n_per_group",
                alpha: float = 0.05) -> DataFrame:
    """Power at each standardised effect size for the design's n per group
    (two-sided, normal approximation): Phi(d*sqrt(n/2) - z_{1-alpha/2}) (X7)."""
    z = norm_ppf(1 - alpha / 2)
    es = design.sparkSession.createDataFrame([(float(e),) for e in effect_sizes], "effect_size double")
    j = design.crossJoin(F.broadcast(es))
    return j.withColumn("power_at_effect",
                        norm_cdf_udf(F.col("effect_size") * F.sqrt(F.col(n_col) / 2.0) - F.lit(z)))


def cell_means(df: DataFrame, a: str, b: str, y: str) -> DataFrame:
    """2x2 table of means: one row per level of ``a``, one column per level of ``b``."""
    return df.groupBy(a).pivot(b, [0, 1]).agg(F.avg(y)).withColumnRenamed("0", f"{b}_0") \
        .withColumnRenamed("1", f"{b}_1").orderBy(a)


def interaction_contrast(df: DataFrame, a: str, b: str, y: str) -> DataFrame:
    """One row: the four cell means and (m11 - m10) - (m01 - m00)."""
    m = {f"m{i}{j}": F.avg(F.when((F.col(a) == i) & (F.col(b) == j), F.col(y))) for i in (0, 1) for j in (0, 1)}
    r = df.agg(*[v.alias(k) for k, v in m.items()])
    return r.withColumn("interaction", (F.col("m11") - F.col("m10")) - (F.col("m01") - F.col("m00")))


def _cells(df: DataFrame, a: str, b: str, y: str) -> DataFrame:
    """One row holding n, sum and sum of squares of each of the four cells,
    computed on y centred at its grand mean (a first one-row pass) so the sums
    of squares do not cancel catastrophically on large inputs. Sums of
    squares are invariant to that shift."""
    known = F.col(a).isin(0, 1) & F.col(b).isin(0, 1)
    d = df.where(F.col(y).isNotNull() & F.col(a).isNotNull() & F.col(b).isNotNull()) \
        .where(F.when(known, True).otherwise(F.raise_error(F.lit(f"{a} and {b} must be 0 or 1")).cast("boolean")))
    mean = d.agg(F.avg(F.col(y).cast("double")).alias("_gm"))
    d = d.crossJoin(F.broadcast(mean))
    aggs = []
    for i in (0, 1):
        for j in (0, 1):
            cond = (F.col(a) == i) & (F.col(b) == j)
            yv = F.col(y).cast("double") - F.col("_gm")
            aggs += [F.count_if(cond).cast("double").alias(f"n{i}{j}"),
                     F.sum(F.when(cond, yv).otherwise(0.0)).alias(f"s{i}{j}"),
                     F.sum(F.when(cond, yv * yv).otherwise(0.0)).alias(f"q{i}{j}")]
    return d.agg(*aggs)


def two_way_anova(df: DataFrame, a: str, b: str, y: str, with_p: bool = True) -> DataFrame:
    """Type II two-way ANOVA with interaction for two binary factors, from
    cell sufficient statistics; works for unbalanced cells. Rows: a, b, a:b,
    Residual with sum_sq, df, F (and PR(>F) when ``with_p``) (X9)."""
    c = _cells(df, a, b, y)
    col = F.col
    N = col("n00") + col("n01") + col("n10") + col("n11")
    S = col("s00") + col("s01") + col("s10") + col("s11")
    Q = col("q00") + col("q01") + col("q10") + col("q11")
    Na, Nb, Nab = col("n10") + col("n11"), col("n01") + col("n11"), col("n11")
    Sa, Sb = col("s10") + col("s11"), col("s01") + col("s11")

    def rss_groups(groups):
        tot = F.lit(0.0)
        for n, s in groups:
            tot = tot + F.when(n > 0, s * s / n).otherwise(0.0)
        return Q - tot

    rss_full = rss_groups([(col(f"n{i}{j}"), col(f"s{i}{j}")) for i in (0, 1) for j in (0, 1)])
    rss_a = rss_groups([(N - Na, S - Sa), (Na, Sa)])
    rss_b = rss_groups([(N - Nb, S - Sb), (Nb, Sb)])
    # additive model y = m + p*a + q*b: solve the 3x3 normal equations by Cramer's rule
    m11, m12, m13 = N, Na, Nb
    m22, m23, m33 = Na, Nab, Nb

    def det3(a11, a12, a13, a21, a22, a23, a31, a32, a33):
        return a11 * (a22 * a33 - a23 * a32) - a12 * (a21 * a33 - a23 * a31) + a13 * (a21 * a32 - a22 * a31)

    det = det3(m11, m12, m13, m12, m22, m23, m13, m23, m33)
    b0 = det3(S, m12, m13, Sa, m22, m23, Sb, m23, m33) / det
    b1 = det3(m11, S, m13, m12, Sa, m23, m13, Sb, m33) / det
    b2 = det3(m11, m12, S, m12, m22, Sa, m13, m23, Sb) / det
    rss_add = Q - (b0 * S + b1 * Sa + b2 * Sb)
    df_res = N - 4
    ss = c.select(
        (rss_b - rss_add).alias("ss_a"), (rss_a - rss_add).alias("ss_b"),
        (rss_add - rss_full).alias("ss_ab"), rss_full.alias("ss_res"), df_res.alias("df_res"))
    mse = F.col("ss_res") / F.col("df_res")
    rows = F.array(
        F.struct(F.lit(a).alias("term"), F.col("ss_a").alias("sum_sq"), F.lit(1.0).alias("df"),
                 (F.col("ss_a") / mse).alias("F")),
        F.struct(F.lit(b).alias("term"), F.col("ss_b").alias("sum_sq"), F.lit(1.0).alias("df"),
                 (F.col("ss_b") / mse).alias("F")),
        F.struct(F.lit(f"{a}:{b}").alias("term"), F.col("ss_ab").alias("sum_sq"), F.lit(1.0).alias("df"),
                 (F.col("ss_ab") / mse).alias("F")),
        F.struct(F.lit("Residual").alias("term"), F.col("ss_res").alias("sum_sq"),
                 F.col("df_res").cast("double").alias("df"), F.lit(None).cast("double").alias("F")))
    out = ss.select(F.explode(rows).alias("r"), "df_res").select("r.*", "df_res")
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("F").isNotNull(),
                                               f_pvalue_udf(F.col("F"), F.col("df"), F.col("df_res"))))
    return out.drop("df_res")
