"""Linear models from cross products (M2-M5).

All that least squares, ridge, lasso, their cross-validation and the variance
inflation need of the data are counts, sums and products of pairs of columns.
Aggregates take them for every fold at once, of columns centred and scaled
beforehand so that nothing cancels; a training part is the total less its fold.
The systems that remain have one row a column and are solved on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement as pairs

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Moments:
    """Count, sums and products of columns; ``+`` joins, ``-`` takes rows away."""

    def __init__(self, n: float, s: np.ndarray, p: np.ndarray):
        self.n, self.s, self.p = n, s, p

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.s + other.s, self.p + other.p)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.s - other.s, self.p - other.p)

    @property
    def mean(self) -> np.ndarray:
        return self.s / max(self.n, 1)

    @property
    def centred(self) -> np.ndarray:
        """Products of the deviations from the means."""
        return self.p - np.outer(self.s, self.s) / max(self.n, 1)


def scaled(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``cols`` centred and divided by their population deviation (0: by 1), with means and deviations."""
    row = df.agg(*[F.avg(f"`{c}`") for c in cols], *[F.stddev_pop(f"`{c}`") for c in cols]).first()
    mean = np.array([v or 0.0 for v in row[:len(cols)]])
    dev = np.array([v or 1.0 for v in row[len(cols):]])
    out = df.withColumns({c: (F.col(f"`{c}`") - F.lit(float(m))) / F.lit(float(d)) for c, m, d in zip(cols, mean, dev)})
    return out, mean, dev


def moment_columns(cols: Sequence[str]) -> list[Column]:
    """n, s (sums of ``cols``) and p (their products, pairs in order)."""
    x = [F.col(f"`{c}`") for c in cols]
    return [F.count(F.lit(1)).alias("n"), F.array(*map(F.sum, x)).alias("s"), F.array(*[F.sum(a * b) for a, b in pairs(x, 2)]).alias("p")]


#: Sums taken in one aggregate. The code of all at once is too long for the JVM to compile, and is interpreted row by row.
AT_ONCE = 16


def moments(df: DataFrame, cols: Sequence[str], fold: str) -> dict:
    """fold: Moments of its rows; aggregates with partial sums, one row a fold on the driver. ``df`` is read once for
    every ``AT_ONCE`` sums, so its rows should be stored."""
    x = [F.col(f"`{c}`") for c in cols]
    wanted = [F.count(F.lit(1)), *map(F.sum, x), *[F.sum(a * b) for a, b in pairs(x, 2)]]
    found: dict = {}
    for low in range(0, len(wanted), AT_ONCE):
        for r in df.groupBy(fold).agg(*[c.alias(f"_{i}") for i, c in enumerate(wanted[low:low + AT_ONCE])]).collect():
            found.setdefault(r[fold], []).extend(r[1:])
    out = {}
    for key, (n, *sums) in found.items():
        p = np.zeros((len(cols), len(cols)))
        for v, (i, j) in zip(sums[len(cols):], pairs(range(len(cols)), 2)):
            p[i, j] = p[j, i] = v
        out[key] = Moments(n, np.array(sums[:len(cols)], float), p)
    return out


# a model is an intercept and weights of the columns but the last, which is the target

def _standardised(m: Moments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Correlation-like products of the features and of features and target, and the features' deviations (0: 1)."""
    c = m.centred
    dev = np.sqrt(np.maximum(np.diag(c)[:-1], 0) / max(m.n, 1))
    dev[dev < 1e-12] = 1.0
    return c[:-1, :-1] / np.outer(dev, dev), c[:-1, -1] / dev, dev


def inverse(a: np.ndarray) -> np.ndarray:
    """Inverse; of a singular matrix the pseudo-inverse."""
    scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    return np.linalg.pinv(a / np.outer(scale, scale), rcond=1e-12, hermitian=True) / np.outer(scale, scale)


def ridge(m: Moments, alpha: float) -> np.ndarray:
    """Weights of the standardised features that minimise squared error + alpha * squared weights."""
    g, b, _ = _standardised(m)
    return inverse(g + alpha * np.eye(len(g))) @ b


def lasso(m: Moments, alpha: float, rounds: int = 10_000, tol: float = 1e-12) -> np.ndarray:
    """Weights that minimise half the mean squared error + alpha * absolute weights, by coordinate descent with
    covariance updates: a step needs the products only, however many rows there are."""
    g, b, _ = _standardised(m)
    g, b = g / max(m.n, 1), b / max(m.n, 1)
    w, left = np.zeros(len(b)), b.copy()  # left: products of the features and the residual
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(b)):
            if g[j, j] <= 0:
                continue
            pull = left[j] + g[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / g[j, j]
            if new != w[j]:
                left -= g[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        if moved <= tol:
            break
    return w


def unscaled(m: Moments, w: np.ndarray) -> np.ndarray:
    """Intercept and weights of the features as they are, from weights of those standardised by ``m``."""
    _, _, dev = _standardised(m)
    own = w / dev
    return np.r_[m.mean[-1] - own @ m.mean[:-1], own]


def r_squared(m: Moments, model: np.ndarray) -> float:
    """R2 of an intercept and weights on the rows of ``m``; NaN if the target does not vary."""
    v = np.r_[-model[1:], 1.0]
    error = v @ m.p @ v - 2 * model[0] * (v @ m.s) + m.n * model[0] ** 2
    total = m.centred[-1, -1]
    return 1 - error / total if total > 0 else float("nan")


def least_squares(m: Moments) -> dict:
    """OLS on standardised features: weights with intercept, standard errors, n, degrees of freedom, R2, adjusted R2, F."""
    g, b, _ = _standardised(m)
    inv = inverse(g)
    w = inv @ b
    total = m.centred[-1, -1]
    error = max(total - w @ b, 0.0)
    rank = int(np.linalg.matrix_rank(g / max(m.n, 1), hermitian=True)) if len(g) else 0
    free = m.n - rank - 1
    var = error / free if free > 0 else float("nan")
    r2 = 1 - error / total if total > 0 else float("nan")
    f = (total - error) / rank / var if free > 0 and rank and var > 0 else float("nan")
    return {"coef": np.r_[m.mean[-1], w], "std_err": np.sqrt(np.r_[var / max(m.n, 1), var * np.diag(inv)]), "n": int(m.n), "df": int(free), "rank": rank,
            "r2": r2, "adj_r2": 1 - (1 - r2) * (m.n - 1) / free if free > 0 else float("nan"), "f": f}


def inflation(m: Moments) -> np.ndarray:
    """Variance inflation of every feature: the diagonal of the inverse correlations."""
    g, _, _ = _standardised(m)
    return np.diag(inverse(g / max(m.n, 1)))
