"""Monthly series: layout, split, differencing, month axis, scoring and forecasts.

Series are kept long — (series, month, value) — so every window is
partitioned by series and many series (country x measure, or one per grid
point of a model search) run side by side.  Model fitting is the only step in
Python: one pandas call per (series, order) group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapanel.operators.sarima import Order, difference_poly, fit_and_forecast

SERIES, MONTH, VALUE = "series", "month", "value"

# Fixed values (must equal the studied scripts): orders chosen for the two
# national monthly series, and the long-range horizon (Jan 2019 .. Jan 2051).
TEMPERATURE_ORDER = Order(2, 1, 1, 2, 1, 1, 12)
PRECIPITATION_ORDER = Order(1, 1, 3, 1, 1, 1, 12)
LONG_HORIZON = 385


def monthly_long(monthly: DataFrame, measures: Sequence[str] = ("temperature", "precipitation"),
                 keys: Sequence[str] = ()) -> DataFrame:
    """(year, month, measures...) -> (keys..., series, month date, value)."""
    base = monthly.select(*keys, F.make_date("year", "month", F.lit(1)).alias(MONTH), *measures)
    return base.unpivot([*keys, MONTH], list(measures), SERIES, VALUE)


def _by_series(keys: Sequence[str] = ()) -> Window:
    return Window.partitionBy(*keys, SERIES).orderBy(MONTH)


def complete_months(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``series`` with a row for each month from its first to its last; a missing month has nulls."""
    ids = [*keys, SERIES]
    step = F.expr("INTERVAL 1 MONTH")
    bounds = series.groupBy(*ids).agg(F.trunc(F.min(MONTH), "month").alias("_first"), F.trunc(F.max(MONTH), "month").alias("_last"))
    months = bounds.select(*[F.col(c).alias(f"_{c}") for c in ids], F.explode(F.sequence("_first", "_last", step)).alias("_axis"))
    same = F.trunc(F.col(MONTH), "month").eqNullSafe(F.col("_axis"))
    for c in ids:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    names = {MONTH: "_axis"} | {c: f"_{c}" for c in ids}
    return months.join(series, same, "left").select(
        *[F.coalesce(c, names[c]).alias(c) if c in names else F.col(f"`{c}`") for c in series.columns])


def with_position(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """1-based position of each month within its series."""
    return series.withColumn("position", F.row_number().over(_by_series(keys)))


def split_by_position(series: DataFrame, n_train: int, n_test: int,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Label the first ``n_train`` months 'train' and the next ``n_test`` 'test'; drop the rest."""
    pos = with_position(series, keys)
    return pos.where(F.col("position") <= n_train + n_test).withColumn(
        "split", F.when(F.col("position") <= n_train, "train").otherwise("test"))


def split_by_date(series: DataFrame, train_end: str, test_end: str) -> DataFrame:
    """Label months up to ``train_end`` 'train' and up to ``test_end`` 'test'."""
    m = F.col(MONTH)
    return series.where(m <= F.lit(test_end).cast("date")).withColumn(
        "split", F.when(m <= F.lit(train_end).cast("date"), "train").otherwise("test"))


def lag_features(series: DataFrame, lags: Sequence[int] = (1, 12, 13),
                 keys: Sequence[str] = ()) -> DataFrame:
    """Add ``lag_k``, the value k calendar months before; a missing month is a row with a null value."""
    w = _by_series(keys)
    return complete_months(series, keys).withColumns({f"lag_{k}": F.lag(VALUE, k).over(w) for k in lags})


def difference_coefficients(d: int = 1, D: int = 1, s: int = 12) -> dict[int, float]:
    """Lag -> coefficient of (1-B)^d (1-B^s)^D."""
    poly = difference_poly(Order(0, d, 0, 0, D, 0, s))
    return {lag: float(c) for lag, c in enumerate(poly) if c != 0}


def seasonal_difference(series: DataFrame, d: int = 1, D: int = 1, s: int = 12,
                        keys: Sequence[str] = ()) -> DataFrame:
    """Add ``diff`` = (1-B)^d (1-B^s)^D value (NULL where the lags reach before the start or a missing month)."""
    w = _by_series(keys)
    terms = [F.lit(c) * (F.col(VALUE) if lag == 0 else F.lag(VALUE, lag).over(w))
             for lag, c in difference_coefficients(d, D, s).items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return complete_months(series, keys).withColumn("diff", total)


def month_axis(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Months touched by the days start <= day < end, in order, with 'Mon-yy' labels.

    ``bounds`` holds one row per axis; the months are generated by
    ``sequence`` and exploded, so no calendar table is needed.
    """
    first = F.trunc(F.col(start), "month")
    last = F.trunc(F.date_sub(F.col(end), 1), "month")
    months = F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.posexplode(months).alias("idx", MONTH)).select(
        (F.col("idx") + 1).alias("idx"), MONTH, F.date_format(MONTH, "MMM-yy").alias("label"))


def seasonal_naive(split: DataFrame, season: int = 12, keys: Sequence[str] = ()) -> DataFrame:
    """Forecast for each test month: the last training value of the same calendar month."""
    moy = F.month(MONTH) if season == 12 else F.col("position") % season
    train = split.where(F.col("split") == "train").withColumn("_moy", moy)
    last = train.groupBy(*keys, SERIES, "_moy").agg(F.max_by(VALUE, MONTH).alias("predicted"))
    test = split.where(F.col("split") == "test").withColumn("_moy", moy)
    return test.join(last, [*keys, SERIES, "_moy"], "left").select(
        *keys, SERIES, MONTH, F.col(VALUE).alias("actual"), "predicted")


def score(compare: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean squared error of predicted against actual per series."""
    return compare.groupBy(*keys, SERIES).agg(
        F.avg(F.pow(F.col("actual") - F.col("predicted"), 2)).alias("mse"),
        F.count(F.lit(1)).alias("n_months"))


FORECAST_SCHEMA = T.StructType([
    T.StructField(SERIES, T.StringType()),
    T.StructField("order_label", T.StringType()),
    T.StructField("origin", T.DateType()),
    T.StructField("step", T.IntegerType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("sigma2", T.DoubleType()),
    T.StructField("css", T.DoubleType()),
    T.StructField("iterations", T.IntegerType()),
    T.StructField("params", T.ArrayType(T.DoubleType())),
    T.StructField("converged", T.BooleanType()),
    T.StructField("reason", T.StringType()),
])

# Order of the model as columns (Spark names are case-insensitive, so P/Q/D
# get their own names): p, d, q, P, D, Q, s.
ORDER_FIELDS = ["ar", "diff", "ma", "sar", "sdiff", "sma", "season"]
_ORDER_ATTRS = ["p", "d", "q", "P", "D", "Q", "s"]


def order_table(spark, orders: Mapping[str, Sequence[Order]]) -> DataFrame:
    """Small (series, order) grid as a DataFrame."""
    rows = [(series, o.label(), *[getattr(o, f) for f in _ORDER_ATTRS])
            for series, lst in orders.items() for o in lst]
    schema = T.StructType([T.StructField(SERIES, T.StringType()),
                           T.StructField("order_label", T.StringType())]
                          + [T.StructField(f, T.IntegerType()) for f in ORDER_FIELDS])
    return spark.createDataFrame(rows, schema)


def _fit_group(horizon: int, keys: Sequence[str] = ()):
    def start_of(first, order: Order) -> np.ndarray | None:
        found = first.get("start")
        if found is None:
            return None
        at = dict(found)
        lags = ([("ar", k) for k in range(1, order.p + 1)] + [("ar", k * order.s) for k in range(1, order.P + 1)]
                + [("ma", k) for k in range(1, order.q + 1)] + [("ma", k * order.s) for k in range(1, order.Q + 1)])
        return np.array([np.nan if at.get(f"{part}{k}") is None else at[f"{part}{k}"] for part, k in lags], float)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(MONTH)
        first = pdf.iloc[0]
        order = Order(*[int(first[f]) for f in ORDER_FIELDS])
        y = pdf[VALUE].to_numpy(dtype=float)
        res = fit_and_forecast(y, order, horizon, start_of(first, order))
        return pd.DataFrame({
            **{k: first[k] for k in keys},
            SERIES: first[SERIES],
            "order_label": first["order_label"],
            "origin": pdf[MONTH].iloc[-1],
            "step": np.arange(1, horizon + 1, dtype=np.int32),
            "yhat": np.array(res["yhat"], dtype=float),
            "sigma2": res["sigma2"],
            "css": res["css"],
            "iterations": np.int32(res["iterations"]),
            "params": [list(map(float, res["params"]))] * horizon,
            "converged": res["converged"],
            "reason": res["reason"],
        })
    return fit


def _ship_code_with_udfs() -> None:
    """Pickle this package's functions by value inside UDFs.

    The grouped fit then carries its own code to the Python workers, which
    need not have the package installed or on their path (only numpy and
    pandas).
    """
    import terrapanel
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(terrapanel)


def fit_forecast(train: DataFrame, orders: DataFrame, horizon: int, keys: Sequence[str] = (),
                 starts: DataFrame | None = None) -> DataFrame:
    """Fit every (keys..., series, order) on ``train`` and forecast ``horizon`` months ahead.

    ``train`` is long (keys..., series, month, value); ``orders`` lists the orders per
    series (and per key, where it has that column).  They meet by an equi-join and each
    is one ``applyInPandas`` group, so the fits spread over the cluster.  ``starts`` (from
    :func:`terrapanel.operators.arma_start.arma_start`) gives the search its starting values.
    Output: keys..., series, order_label, month, step, yhat and the fit statistics with ``converged``; a series
    that cannot be fitted, for one with a missing month, has no yhat but a ``reason``, and the others are not affected.
    """
    _ship_code_with_udfs()
    on = [c for c in [*keys, SERIES] if c in orders.columns]
    ids = [*keys, SERIES, "order_label"]
    grid = complete_months(train.select(*keys, SERIES, MONTH, VALUE), keys).join(orders, on)
    if starts is not None:
        term = F.concat("part", F.col("lag").cast("string"))
        grid = grid.join(starts.groupBy(*ids).agg(F.map_from_entries(F.collect_list(F.struct(term, "start"))).alias("start")), ids, "left")
    schema = T.StructType([train.schema[k] for k in keys] + FORECAST_SCHEMA.fields)
    fitted = grid.groupBy(*ids).applyInPandas(_fit_group(horizon, keys), schema)
    return fitted.withColumn(MONTH, F.add_months("origin", F.col("step"))).drop("origin")
