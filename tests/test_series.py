import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapanel.functions.weather import fahrenheit_to_celsius
from terrapanel.operators.sarima import Order, difference_poly, fit_and_forecast, polys
from terrapanel.operators.series import (
    fit_forecast,
    lag_features,
    month_axis,
    order_table,
    seasonal_difference,
    seasonal_naive,
    split_by_position,
)


def _axis(spark, start, end):
    b = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))],
                              "start date, end date")
    return [r.label for r in month_axis(b).orderBy("idx").collect()]


def test_month_axis(spark):
    short = _axis(spark, "2019-01-01", "2020-05-30")
    assert len(short) == 17 and short[0] == "Jan-19" and short[-1] == "May-20"
    long = _axis(spark, "2019-01-01", "2051-01-30")
    assert len(long) == 385 and long[-1] == "Jan-51"


def test_fahrenheit_to_celsius(spark):
    df = spark.createDataFrame([(32.0,), (212.0,)], "f double")
    assert [r.c for r in df.select(fahrenheit_to_celsius("f").alias("c")).collect()] == pytest.approx([0, 100])


def _series(spark, values, name="s"):
    rows = [(name, dt.date(2000 + i // 12, 1 + i % 12, 1), float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, month date, value double")


def test_seasonal_difference_of_trend_plus_season(spark):
    season = [3, -1, 4, 1, -5, 9, 2, -6, 5, 3, -5, 8]
    y = [t + season[t % 12] for t in range(48)]
    got = [r["diff"] for r in seasonal_difference(_series(spark, y)).orderBy("month").collect()]
    assert all(v is None for v in got[:13])
    assert got[13:] == pytest.approx([0.0] * 35)


def test_a_missing_month_shifts_nothing(spark):
    """Lags and differences go by the calendar; a fit over a hole has a reason and no forecast."""
    months = _series(spark, range(48)).where("month <> '2001-06-01'")
    got = {r.month: r for r in lag_features(months).collect()}
    assert len(got) == 48 and got[dt.date(2001, 6, 1)].value is None
    assert got[dt.date(2001, 7, 1)].lag_1 is None and got[dt.date(2002, 6, 1)].lag_12 is None and got[dt.date(2002, 7, 1)].lag_13 is None
    assert (got[dt.date(2002, 7, 1)].lag_1, got[dt.date(2002, 7, 1)].lag_12) == (29.0, 18.0)
    diff = {r.month: r.diff for r in seasonal_difference(months).collect()}
    hole = {dt.date(2001, 6, 1), dt.date(2001, 7, 1), dt.date(2002, 6, 1), dt.date(2002, 7, 1)}
    assert {m for m, d in diff.items() if d is None and m >= dt.date(2001, 2, 1)} == hole
    fits = fit_forecast(months, order_table(spark, {"s": [Order(0, 1, 0, 0, 1, 0, 12)]}), 2).collect()
    assert [r.reason for r in fits] == ["a value is missing"] * 2 and all(r.yhat is None or r.yhat != r.yhat for r in fits)


def test_split_and_naive(spark):
    y = list(range(30))
    split = split_by_position(_series(spark, y), 24, 4)
    assert split.where("split = 'train'").count() == 24 and split.where("split = 'test'").count() == 4
    naive = {r.month: (r.actual, r.predicted) for r in seasonal_naive(split).collect()}
    assert naive[dt.date(2002, 1, 1)] == (24.0, 12.0)


def _simulate(order, params, n, rng, burn=300):
    ar, ma = polys(np.array(params), order)
    full = np.convolve(ar, difference_poly(order))
    e = rng.normal(size=n + burn)
    y = np.zeros(n + burn)
    for t in range(len(full), n + burn):
        y[t] = (-sum(full[i] * y[t - i] for i in range(1, len(full))) + e[t]
                + sum(ma[j] * e[t - j] for j in range(1, len(ma))))
    return y[burn:]


@pytest.mark.parametrize("order,params", [
    (Order(2, 1, 1, 2, 1, 1, 12), [0.4, -0.2, 0.3, -0.3, -0.2, -0.5]),
    (Order(1, 1, 3, 1, 1, 1, 12), [0.5, 0.2, -0.1, 0.1, -0.2, -0.6]),
])
def test_css_fit_recovers_innovation_variance(order, params):
    y = _simulate(order, params, 1068, np.random.default_rng(1))
    res = fit_and_forecast(y, order, 17)
    assert abs(res["sigma2"] - 1.0) < 0.15
    assert len(res["yhat"]) == 17 and np.all(np.isfinite(res["yhat"]))


def test_noiseless_line_is_forecast_exactly():
    t = np.arange(120)
    y = 0.5 * t + 3 * np.sin(2 * np.pi * t / 12)
    res = fit_and_forecast(y[:108], Order(2, 1, 1, 2, 1, 1, 12), 12)
    assert np.max(np.abs(res["yhat"] - y[108:])) < 1e-8


def test_grouped_fit_runs_per_series_and_order(spark):
    rng = np.random.default_rng(5)
    t = np.arange(96)
    a = 10 + 0.1 * t + 5 * np.sin(2 * np.pi * t / 12) + rng.normal(size=96) * 0.3
    b = 3 + 2 * np.cos(2 * np.pi * t / 12) + rng.normal(size=96) * 0.3
    train = _series(spark, a[:84], "a").unionByName(_series(spark, b[:84], "b"))
    orders = order_table(spark, {"a": [Order(1, 1, 1, 0, 1, 1, 12), Order(0, 1, 1, 0, 1, 1, 12)],
                                 "b": [Order(0, 1, 1, 0, 1, 1, 12)]})
    fc = fit_forecast(train, orders, 12)
    assert fc.count() == 36
    first = fc.where((F.col("series") == "a") & (F.col("step") == 1)).first()
    assert first.month == dt.date(2007, 1, 1)
    errs = fc.where("series = 'b'").orderBy("step").toPandas()["yhat"].to_numpy() - b[84:]
    assert np.sqrt(np.mean(errs ** 2)) < 1.5


def test_short_or_broken_series_get_a_reason_and_no_forecast():
    import numpy as np

    from terrapanel.operators.sarima import Order, fit_and_forecast, min_length

    order = Order(2, 1, 1, 2, 1, 1, 12)
    y = 10 + np.sin(np.arange(90) * np.pi / 6) + np.random.default_rng(1).normal(0, 0.1, 90)
    for n in (0, 1, 10, 14, 26, 38, 39, min_length(order) - 1):
        res = fit_and_forecast(y[:n], order, 3)
        assert res["yhat"] == [None] * 3 and "needs" in res["reason"] and not res["converged"]
    hole = y.copy()
    hole[5] = np.nan
    assert fit_and_forecast(hole, order, 2)["reason"] == "a value is missing"
    assert np.isfinite(fit_and_forecast(y[:min_length(order)], order, 3)["yhat"]).all()


def test_fits_converge_inside_the_admissible_region():
    import numpy as np

    from terrapanel.operators.sarima import Order, admissible, fit_and_forecast, polys

    rng = np.random.default_rng(2)
    for order in (Order(2, 1, 1, 2, 1, 1, 12), Order(1, 1, 3, 1, 1, 1, 12), Order(0, 1, 1, 0, 1, 1, 12)):
        raw = rng.normal(0, 3, order.n_params)
        for poly in polys(admissible(raw, order), order):
            assert len(poly) == 1 or np.abs(np.roots(poly[::-1])).min() > 1.0
        y = np.cumsum(rng.normal(0, 1, 96)) + 5 * np.sin(np.arange(96) * np.pi / 6)
        res = fit_and_forecast(y, order, 12)
        assert res["converged"] and np.isfinite(res["yhat"]).all()
        for poly in polys(res["params"], order):
            assert len(poly) == 1 or np.abs(np.roots(poly[::-1])).min() > 1.0


def test_one_bad_series_leaves_the_others(spark):
    from terrapanel.operators.sarima import Order
    from terrapanel.operators.series import fit_forecast, order_table

    rows = [("long", f"{1990 + k // 12}-{k % 12 + 1:02d}-01", float(k % 12 + (k * 7 % 5) / 10)) for k in range(60)]
    rows += [("short", f"1990-{k + 1:02d}-01", 1.0 * k) for k in range(8)]
    train = spark.createDataFrame(rows, "series string, month string, value double").selectExpr("series", "to_date(month) month", "value")
    order = Order(0, 1, 1, 0, 1, 1, 12)
    out = fit_forecast(train, order_table(spark, {"long": [order], "short": [order]}), 2).collect()
    assert {(r.series, r.yhat is None or r.yhat != r.yhat, r.reason is None) for r in out} == {("long", False, True), ("short", True, False)}
