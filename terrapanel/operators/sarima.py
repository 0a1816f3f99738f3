"""Seasonal ARIMA by conditional sum of squares, for one series at a time.

Small numpy helper called inside ``applyInPandas`` (one call per series and
order); the distribution over series and orders is Spark's.

Model: phi(B) Phi(B^s) (1-B)^d (1-B^s)^D y_t = theta(B) Theta(B^s) e_t, no
trend.  The differenced series is filtered to residuals with pre-sample
residuals set to 0 (conditional sum of squares) and the squared residuals
are minimised by damped Gauss-Newton (Levenberg-Marquardt) with a
forward-difference Jacobian, started from zero or from given values, over partial
autocorrelations, which keeps AR stationary and MA invertible.  Forecasts run
the full recursion with future innovations 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Order:
    p: int
    d: int
    q: int
    P: int
    D: int
    Q: int
    s: int

    @property
    def n_params(self) -> int:
        return self.p + self.P + self.q + self.Q

    def label(self) -> str:
        return f"({self.p},{self.d},{self.q})({self.P},{self.D},{self.Q},{self.s})"


def _lag_poly(coefs: np.ndarray, step: int, sign: float) -> np.ndarray:
    """1 + sign*c1 B^step + sign*c2 B^(2 step) + ..."""
    out = np.zeros(len(coefs) * step + 1)
    out[0] = 1.0
    for i, c in enumerate(coefs, start=1):
        out[i * step] = sign * c
    return out


def polys(params: np.ndarray, order: Order) -> tuple[np.ndarray, np.ndarray]:
    """Expanded AR polynomial phi(B)Phi(B^s) and MA polynomial theta(B)Theta(B^s)."""
    p, P, q, Q = order.p, order.P, order.q, order.Q
    phi, Phi = params[:p], params[p:p + P]
    theta, Theta = params[p + P:p + P + q], params[p + P + q:]
    ar = np.convolve(_lag_poly(phi, 1, -1.0), _lag_poly(Phi, order.s, -1.0))
    ma = np.convolve(_lag_poly(theta, 1, 1.0), _lag_poly(Theta, order.s, 1.0))
    return ar, ma


def difference_poly(order: Order) -> np.ndarray:
    out = np.array([1.0])
    for _ in range(order.d):
        out = np.convolve(out, [1.0, -1.0])
    seasonal = np.zeros(order.s + 1)
    seasonal[0], seasonal[-1] = 1.0, -1.0
    for _ in range(order.D):
        out = np.convolve(out, seasonal)
    return out


def residuals(w: np.ndarray, params: np.ndarray, order: Order) -> np.ndarray:
    """Innovations e_t, t >= len(ar)-1, of the differenced series ``w`` (earlier e are 0)."""
    ar, ma = polys(params, order)
    start = len(ar) - 1
    n = len(w)
    if n <= start:
        return np.zeros(0)
    u = np.convolve(w, ar)[:n]
    lags = np.nonzero(ma[1:])[0] + 1
    coef = ma[lags]
    e = np.zeros(n)
    for t in range(start, n):
        acc = u[t]
        for lag, c in zip(lags, coef):
            if t - lag >= start:
                acc -= c * e[t - lag]
        e[t] = acc
    return e[start:]


def _from_partial(raw: np.ndarray) -> np.ndarray:
    """Coefficients c of a polynomial 1 - c1 B - c2 B^2 - ... with all roots outside the unit circle.

    ``raw`` are any real numbers; their tanh, kept a little inside, are the partial
    autocorrelations, and the Durbin-Levinson recursion makes coefficients of them, so every
    ``raw`` is admissible.
    """
    coefs = np.zeros(0)
    for r in 0.9999 * np.tanh(raw):
        coefs = np.append(coefs - r * coefs[::-1], r)
    return coefs


def admissible(raw: np.ndarray, order: Order) -> np.ndarray:
    """Stationary AR and invertible MA parameters of the unbounded search parameters."""
    cuts = np.cumsum([order.p, order.P, order.q])
    phi, seasonal_phi, theta, seasonal_theta = np.split(np.asarray(raw, float), cuts)
    return np.concatenate([_from_partial(phi), _from_partial(seasonal_phi),
                           -_from_partial(theta), -_from_partial(seasonal_theta)])


def _to_partial(coefs: np.ndarray) -> np.ndarray:
    """Search parameters whose :func:`_from_partial` is ``coefs``; partial autocorrelations are kept within 0.95."""
    left, raw = np.asarray(coefs, float), []
    while len(left):
        r = float(np.clip(left[-1], -0.95, 0.95))
        raw.append(np.arctanh(r / 0.9999))
        left = (left[:-1] + r * left[:-1][::-1]) / (1 - r * r)
    return np.array(raw[::-1])


def search_start(params: np.ndarray, order: Order) -> np.ndarray:
    """Search parameters of given model parameters, drawn into the admissible range where they lie outside."""
    phi, seasonal_phi, theta, seasonal_theta = np.split(np.asarray(params, float), np.cumsum([order.p, order.P, order.q]))
    return np.concatenate([_to_partial(phi), _to_partial(seasonal_phi), _to_partial(-theta), _to_partial(-seasonal_theta)])


def min_length(order: Order) -> int:
    """Observations that one residual more than there are parameters needs."""
    return order.d + order.s * order.D + order.p + order.s * order.P + order.n_params + 1


def fit_css(w: np.ndarray, order: Order, max_iter: int = 1000, tol: float = 1e-9,
            start: np.ndarray | None = None) -> tuple[np.ndarray, float, int, bool]:
    """Least-squares parameters, sum of squared residuals, iterations used, and whether the search converged.

    Damped Gauss-Newton over the unbounded parameters.  It has converged when a step improves the
    sum by less than ``tol`` of it, or when no damped step improves it at all; ``max_iter``
    steps without that are reported as not converged.  It begins at zero, or at the model parameters
    ``start`` where they leave a smaller sum.
    """
    k = order.n_params
    raw = np.zeros(k)

    def at(x: np.ndarray) -> np.ndarray:
        return residuals(w, admissible(x, order), order)

    r = at(raw)
    ssr = float(r @ r)
    if start is not None and k and np.isfinite(start).all():
        there = search_start(start, order)
        rt = at(there)
        if float(rt @ rt) < ssr:
            raw, r, ssr = there, rt, float(rt @ rt)
    if k == 0 or ssr == 0.0:
        return admissible(raw, order), ssr, 0, True
    mu, small = 1e-3, 0
    for it in range(1, max_iter + 1):
        jac = np.empty((len(r), k))
        for j in range(k):
            h = 1e-6 * max(1.0, abs(raw[j]))
            bumped = raw.copy()
            bumped[j] += h
            jac[:, j] = (at(bumped) - r) / h
        jtj, grad = jac.T @ jac, jac.T @ r
        scale = np.diag(np.diag(jtj) + 1e-9 * (1.0 + np.trace(jtj) / k))
        while mu < 1e12:
            cand = raw - np.linalg.solve(jtj + mu * scale, grad)
            rc = at(cand)
            sc = float(rc @ rc)
            if np.isfinite(sc) and sc < ssr:
                break
            mu *= 4.0
        else:
            return admissible(raw, order), ssr, it, True
        small = small + 1 if ssr - sc < tol * ssr else 0
        raw, r, ssr = cand, rc, sc
        mu = max(mu / 3.0, 1e-12)
        if small == 3:
            return admissible(raw, order), ssr, it, True
    return admissible(raw, order), ssr, max_iter, False


def forecast(y: np.ndarray, params: np.ndarray, order: Order, horizon: int) -> np.ndarray:
    """h-step forecasts (h = 1..horizon) from the end of ``y``."""
    delta = difference_poly(order)
    ar, ma = polys(params, order)
    full_ar = np.convolve(ar, delta)
    n = len(y)
    lead = len(delta) - 1
    w = np.convolve(y, delta)[lead:n]
    e_w = residuals(w, params, order)
    e = np.zeros(n + horizon)
    start = lead + len(ar) - 1
    e[start:n] = e_w
    yy = np.concatenate([y.astype(float), np.zeros(horizon)])
    ar_lags = np.nonzero(full_ar[1:])[0] + 1
    ma_lags = np.nonzero(ma[1:])[0] + 1
    for t in range(n, n + horizon):
        acc = 0.0
        for lag in ar_lags:
            acc -= full_ar[lag] * yy[t - lag]
        for lag in ma_lags:
            acc += ma[lag] * e[t - lag]
        yy[t] = acc
    return yy[n:]


def fit_and_forecast(y: np.ndarray, order: Order, horizon: int, start: np.ndarray | None = None) -> dict:
    """Fit on ``y`` and forecast: params, sigma2, css, iterations, converged, yhat, reason.

    A series that is too short for the order, or has a value missing, gets no forecast but a reason.
    """
    none = {"params": np.zeros(0), "css": None, "sigma2": None, "iterations": 0, "converged": False,
            "yhat": [None] * horizon}
    if not np.isfinite(y).all():
        return none | {"reason": "a value is missing"}
    if len(y) < min_length(order):
        return none | {"reason": f"{len(y)} values where the order needs {min_length(order)}"}
    delta = difference_poly(order)
    w = np.convolve(y, delta)[len(delta) - 1:len(y)]
    if np.allclose(w, 0.0):
        params, ssr, it, converged = np.zeros(order.n_params), 0.0, 0, True
    else:
        params, ssr, it, converged = fit_css(w, order, start=start)
    return {
        "params": params,
        "css": ssr,
        "sigma2": ssr / max(len(residuals(w, params, order)), 1),
        "iterations": it,
        "converged": converged,
        "yhat": forecast(y, params, order, horizon),
        "reason": None,
    }
