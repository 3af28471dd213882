"""Distribution functions for test statistics (normal, Student t, F).

Spark has no t or F distribution functions and scipy is not available, so the
regularised incomplete beta function is evaluated with the standard continued
fraction (modified Lentz). These are applied only to small results (one row per
test or per coefficient), either on the driver or through the vectorised
pandas UDFs below.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_N = NormalDist()


def norm_cdf(x: float) -> float:
    return _N.cdf(x)


def norm_ppf(p: float) -> float:
    return _N.inv_cdf(p)


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_cdf(t: float, df: float) -> float:
    if math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 1.0 if t > 0 else 0.0
    x = df / (df + t * t)
    tail = 0.5 * betainc(df / 2.0, 0.5, x)
    return 1.0 - tail if t > 0 else tail


def t_sf_two_sided(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    if t is None or df is None or math.isnan(t) or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t)) if not math.isinf(t) else 0.0


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student's t by bisection on the CDF."""
    if not 0.0 < p < 1.0:
        raise ValueError("p must lie in (0, 1)")
    lo, hi = -1.0, 1.0
    while t_cdf(lo, df) > p:
        lo *= 2.0
    while t_cdf(hi, df) < p:
        hi *= 2.0
    for _ in range(200):
        mid = 0.5 * (lo + hi)
        if t_cdf(mid, df) < p:
            lo = mid
        else:
            hi = mid
        if hi - lo < 1e-12:
            break
    return 0.5 * (lo + hi)


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail P(F > f) of the F distribution."""
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _vec(fn, *cols: pd.Series) -> pd.Series:
    arrs = [c.to_numpy(dtype="float64", na_value=np.nan) for c in cols]
    out = np.array([fn(*vals) for vals in zip(*arrs)], dtype="float64")
    return pd.Series(out)


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided t-test p-value as a column (vectorised over Arrow batches)."""
    return _vec(t_sf_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def f_pvalue_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    """Upper-tail F-test p-value as a column."""
    return _vec(f_sf, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def norm_cdf_udf(x: pd.Series) -> pd.Series:
    """Standard normal CDF as a column (Spark has no erf)."""
    return _vec(norm_cdf, x)
