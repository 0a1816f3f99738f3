"""Two-stage starting values against plain least squares, and their use by the fit."""

import datetime as dt

import numpy as np
import pytest

from terrapanel.operators.arma_start import arma_start
from terrapanel.operators.sarima import Order, _from_partial, _to_partial, difference_poly
from terrapanel.operators.series import fit_forecast, order_table

ORDERS = [Order(2, 1, 1, 1, 1, 1, 12), Order(1, 0, 0, 1, 0, 0, 12), Order(1, 0, 2, 0, 0, 0, 12)]


def _month(i):
    return dt.date(1960 + i // 12, i % 12 + 1, 1)


def _walk(seed, n=150):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n)
    y = np.zeros(n)
    for t in range(n):
        y[t] = 0.6 * (y[t - 1] if t else 0) + e[t] + 0.4 * (e[t - 1] if t else 0) + 3 * np.sin(t * np.pi / 6)
    return y


def _table(spark, series):
    rows = [(k, s, _month(i), float(v)) for (k, s), y in series.items() for i, v in enumerate(y) if not np.isnan(v)]
    return spark.createDataFrame(rows, "place string, series string, month date, value double")


def _brute(y, order):
    """{(part, lag): value} by lstsq over whole rows; a nan takes out the rows that look at it."""
    delta = difference_poly(order)
    w = np.full(len(y), np.nan)
    for t in range(len(delta) - 1, len(y)):
        w[t] = sum(c * y[t - i] for i, c in enumerate(delta) if c)
    own = list(range(1, order.q + order.s * order.Q + 1))
    ar = list(range(1, order.p + 1)) + [k * order.s for k in range(1, order.P + 1)]
    ma = list(range(1, order.q + 1)) + [k * order.s for k in range(1, order.Q + 1)]

    def regress(columns):
        x = np.full((len(w), len(columns)), np.nan)
        for c, (v, lag) in enumerate(columns):
            x[lag:, c] = v[:len(w) - lag]
        ok = np.isfinite(w) & np.isfinite(x).all(axis=1)
        beta = np.linalg.lstsq(x[ok], w[ok], rcond=None)[0] if ok.sum() > len(columns) else np.full(len(columns), np.nan)
        return beta, w - x @ beta, int(ok.sum())

    e = regress([(w, k) for k in own])[1] if own else w
    beta, _, n = regress([(w, k) for k in ar] + [(e, k) for k in ma])
    return dict(zip([("ar", k) for k in ar] + [("ma", k) for k in ma], beta)), n


def test_equals_least_squares(spark):
    hole = _walk(3)
    hole[70] = np.nan
    series = {("a", "s"): _walk(1), ("b", "s"): _walk(2), ("a", "r"): hole, ("b", "r"): _walk(4, 20)}
    got = arma_start(_table(spark, series), order_table(spark, {"s": ORDERS, "r": ORDERS}), keys=["place"]).collect()
    found = {(r.place, r.series, r.order_label, r.part, r.lag): (r.start, r.n_rows) for r in got}
    assert len(found) == len(got) == len(series) * sum(o.n_params for o in ORDERS)
    for (place, name), y in series.items():
        for order in ORDERS:
            want, n = _brute(y, order)
            for (part, lag), v in want.items():
                start, rows = found[place, name, order.label(), part, lag]
                assert rows == n, (place, name, order)
                assert (start is None) == bool(np.isnan(v)), (place, name, order, part, lag)
                if start is not None:
                    assert start == pytest.approx(v, abs=1e-8)
    assert all(v[0] is None for k, v in found.items() if k[:2] == ("b", "r") and k[2] == ORDERS[0].label())


def test_awkward_series(spark):
    """Constant, empty, repeated months: no value, no crash, and the others are not affected."""
    same, good = np.full(100, 5.0), _walk(5, 100)
    df = _table(spark, {("a", "s"): same, ("b", "s"): good, ("c", "s"): good})
    df = df.unionByName(df.where("place = 'c'"))
    orders = order_table(spark, {"s": [ORDERS[1]]})
    got = {(r.place, r.lag): r.start for r in arma_start(df, orders, keys=["place"]).collect()}
    want, _ = _brute(good, ORDERS[1])
    assert got[("b", 1)] == pytest.approx(want[("ar", 1)]) and got[("b", 12)] == pytest.approx(want[("ar", 12)])
    assert got[("a", 1)] is None and got[("a", 12)] is None        # the two lags are one column
    assert got[("c", 1)] is None and got[("c", 12)] is None
    assert arma_start(df.limit(0), orders, keys=["place"]).count() == 0


def test_partial_round_trip():
    raw = np.array([0.3, -0.8, 0.5])
    assert np.allclose(_to_partial(_from_partial(raw)), raw)
    assert np.isfinite(_to_partial(np.array([1.7, -2.0]))).all()    # drawn into the admissible range


def test_fit_from_starts(spark):
    """The same optimum is found from the starting values, for each key on its own."""
    df = _table(spark, {("a", "s"): _walk(6), ("b", "s"): _walk(7)})
    orders = order_table(spark, {"s": [Order(1, 0, 1, 0, 1, 1, 12)]})
    starts = arma_start(df, orders, keys=["place"])
    cold = {(r.place, r.step): r for r in fit_forecast(df, orders, 3, keys=["place"]).collect()}
    warm = {(r.place, r.step): r for r in fit_forecast(df, orders, 3, keys=["place"], starts=starts).collect()}
    assert set(cold) == set(warm) == {(p, h) for p in "ab" for h in (1, 2, 3)}
    for k, r in warm.items():
        assert r.converged and r.css <= cold[k].css * (1 + 1e-4)
        assert r.yhat == pytest.approx(cold[k].yhat, abs=0.1)
        assert r.month == cold[k].month
