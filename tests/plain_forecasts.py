"""One series at a time, step by step: what the distributed forecasters must agree with."""

import numpy as np

SEASON = 4
YEAR_WEEKS = 52.1775
Z80, Z95 = 1.2815515655446004, 1.959963984540054


def fit_ar(y: np.ndarray, steps: int, season: int = SEASON):
    """AR(p) plus an optional seasonal lag, least squares, order by AIC over
    p in 0..3 and seasonal in {0, 1}; recursive forecast; normal interval
    whose variance grows with the horizon."""
    n = len(y)
    best = None
    for p in range(0, 4):
        for s in (0, 1):
            lags = list(range(1, p + 1)) + ([season] if s and season > p else [])
            m = max(lags) if lags else 0
            if n - m < len(lags) + 3:
                continue
            X = np.column_stack([np.ones(n - m)] + [y[m - k:n - k] for k in lags])
            tgt = y[m:]
            beta, *_ = np.linalg.lstsq(X, tgt, rcond=None)
            resid = tgt - X @ beta
            sigma2 = max(float(resid @ resid) / len(tgt), 1e-12)
            aic = len(tgt) * np.log(sigma2) + 2 * (len(lags) + 1)
            if best is None or aic < best[0]:
                best = (aic, lags, beta, sigma2)
    if best is None:
        last = float(y[-1]) if n else 0.0
        f = np.full(steps, last)
        return f, f, f
    _, lags, beta, sigma2 = best
    hist = list(y.astype(float))
    out = []
    for _ in range(steps):
        x = [1.0] + [hist[-k] for k in lags]
        v = float(np.dot(beta, x))
        out.append(v)
        hist.append(v)
    f = np.array(out)
    half = Z95 * np.sqrt(sigma2 * np.arange(1, steps + 1))
    return f, f - half, f + half


_HW_GRID = np.array([(a, b, g) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.05, 0.2, 0.5)
                     for g in (0.05, 0.3, 0.6)])


def fit_holt_winters(y: np.ndarray, steps: int, season: int = SEASON):
    """Additive trend + additive seasonality (period ``season``); smoothing
    constants chosen by one-step squared error over a fixed grid, evaluated
    for all grid points at once; band +-20 %. Fewer than 2 seasons of data:
    last value."""
    n = len(y)
    if n < 2 * season:
        last = float(y[-1]) if n else 0.0
        f = np.full(steps, last)
        return f, f - 0.2 * np.abs(f), f + 0.2 * np.abs(f)
    a, b, g = _HW_GRID[:, 0], _HW_GRID[:, 1], _HW_GRID[:, 2]
    k = len(_HW_GRID)
    level = np.full(k, y[:season].mean())
    trend = np.full(k, (y[season:2 * season].mean() - y[:season].mean()) / season)
    seas = np.tile(y[:season] - y[:season].mean(), (k, 1))
    sse = np.zeros(k)
    for t in range(season, n):
        si = t % season
        pred = level + trend + seas[:, si]
        err = y[t] - pred
        sse += err * err
        new_level = a * (y[t] - seas[:, si]) + (1 - a) * (level + trend)
        trend = b * (new_level - level) + (1 - b) * trend
        seas[:, si] = g * (y[t] - new_level) + (1 - g) * seas[:, si]
        level = new_level
    i = int(np.argmin(sse))
    h = np.arange(1, steps + 1)
    f = level[i] + h * trend[i] + seas[i, (n + h - 1) % season]
    return f, f - 0.2 * np.abs(f), f + 0.2 * np.abs(f)


def fit_trend_seasonal(t: np.ndarray, y: np.ndarray, steps: int, n_changepoints: int = 8,
                       order: int = 3, ridge: float = 1.0):
    """Piecewise-linear trend (hinges at quantiles of the first 80 % of the
    history) plus yearly Fourier terms, ridge-penalised except intercept and
    slope; 80 % interval from the residual spread. Returns forecast, lower,
    upper, trend and seasonal components."""
    n = len(y)
    cps = np.quantile(t[: max(int(0.8 * n), 1)], np.linspace(0, 1, n_changepoints + 2)[1:-1]) if n > 3 else []

    def design(tt):
        cols = [np.ones_like(tt, dtype=float), tt.astype(float)]
        cols += [np.maximum(tt - c, 0.0) for c in cps]
        trend_cols = len(cols)
        for kk in range(1, order + 1):
            w = 2 * np.pi * kk * tt / YEAR_WEEKS
            cols += [np.sin(w), np.cos(w)]
        return np.column_stack(cols), trend_cols

    X, nt = design(t)
    pen = np.full(X.shape[1], ridge)
    pen[:2] = 0.0
    beta = np.linalg.lstsq(X.T @ X + np.diag(pen), X.T @ y, rcond=None)[0]
    resid = y - X @ beta
    sd = float(np.sqrt(resid @ resid / max(n - 1, 1)))
    tf = t[-1] + np.arange(1, steps + 1)
    Xf, _ = design(tf)
    f = Xf @ beta
    trend = Xf[:, :nt] @ beta[:nt]
    return f, f - Z80 * sd, f + Z80 * sd, trend, f - trend
