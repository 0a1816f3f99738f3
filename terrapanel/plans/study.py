"""The three analyses of the study, end to end from raw inputs.

Each function takes DataFrames (as read by :mod:`terrapanel.sources.files`)
and returns result DataFrames instead of printing:

* :func:`hypothesis_tests` — readings -> country by coordinates -> yearly
  means -> panel with CO2, energy and population -> fixed-effects ridge with
  country and year dummies -> coefficients, fitted values and the six tests.
* :func:`country_betas` — same panel -> per-country standardised OLS ->
  betas ranked by the CO2 coefficient, and those of the ten highest and ten
  lowest average emitters.
* :func:`monthly_forecast` — readings -> monthly national means -> positional
  train/test split -> seasonal ARIMA per measure -> holdout comparison, error
  and long-range forecast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.functions.weather import fahrenheit_to_celsius
from terrapanel.operators.clean import clean_observations
from terrapanel.operators.geo import geocode
from terrapanel.operators.panel import (
    drop_short_first_year,
    build_panel,
    country_year_by_position,
    month_series,
    position_year_sums,
)
from terrapanel.operators.rank import bottom_k, group_average, members_of, top_k
from terrapanel.operators.regress import fit_pooled, group_betas, pooled_effects, pooled_predictions
from terrapanel.operators.series import (
    LONG_HORIZON,
    MONTH,
    PRECIPITATION_ORDER,
    SERIES,
    TEMPERATURE_ORDER,
    VALUE,
    fit_forecast,
    monthly_long,
    order_table,
    score,
    split_by_position,
)
from terrapanel.session import cut_lineage


def country_panel(
    observations: DataFrame,
    places: DataFrame,
    iso: DataFrame,
    co2: DataFrame,
    energy: DataFrame,
    population: DataFrame,
) -> DataFrame:
    """Readings (with coordinates) + indicator tables -> the country/year panel.

    ``observations``: station, obs_date, latitude, longitude, temp, prcp,
    prcp_flag, snow_depth.  Indicator tables: country_code, year, and one
    value column named ``co2`` / ``energy`` / ``population``.  Only readings
    with a position count, each where it was taken.  The readings are scanned
    once: positions to look up come from the sums by position and year.
    """
    sums = cut_lineage(position_year_sums(clean_observations(observations, require_coordinates=True)))
    wx = country_year_by_position(sums, geocode(sums, places, iso))
    panel = build_panel(wx.select("country_code", "year", "temperature", "precipitation"),
                        co2.where(F.col("co2").isNotNull()),
                        energy.where(F.col("energy").isNotNull()),
                        population.where(F.col("population").isNotNull()))
    return cut_lineage(panel)


@dataclass
class PooledResult:
    coefficients: DataFrame
    predictions: DataFrame
    tests: DataFrame


def hypothesis_tests(panel: DataFrame, lam: float = 1.0, alpha: float = 0.05) -> PooledResult:
    fit = fit_pooled(panel, lam=lam)
    coefficients, tests = pooled_effects(panel, alpha=alpha, fit=fit)
    return PooledResult(coefficients, pooled_predictions(panel, fit=fit), tests)


@dataclass
class BetaResult:
    betas: DataFrame
    top_by_co2_beta: DataFrame
    most_emitting: DataFrame
    least_emitting: DataFrame


def country_betas(panel: DataFrame, k: int = 10) -> BetaResult:
    betas = cut_lineage(group_betas(panel, rank_deficient="pinv"))
    avg = group_average(panel, "country_code", "co2", "avg_co2", cast="float")
    high = top_k(avg, "avg_co2", k, tie=["country_code"])
    low = bottom_k(avg, "avg_co2", k, tie=["country_code"])

    def ranked(df: DataFrame) -> DataFrame:
        return top_k(df, "co2", k, tie=["country_code"])

    return BetaResult(betas, ranked(betas), ranked(members_of(betas, high, "country_code")),
                      ranked(members_of(betas, low, "country_code")))


@dataclass
class ForecastResult:
    holdout: DataFrame
    holdout_mse: DataFrame
    long_range: DataFrame


def monthly_forecast(
    observations: DataFrame,
    n_train: int,
    n_test: int,
    horizon: int = LONG_HORIZON,
    drop_partial_first_year: bool = True,
) -> ForecastResult:
    """Monthly means of all readings, split by position, fitted per measure."""
    monthly = month_series(clean_observations(observations))
    if drop_partial_first_year:
        monthly = drop_short_first_year(monthly)
    split = split_by_position(monthly_long(cut_lineage(monthly)), n_train, n_test)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test").select(SERIES, MONTH, F.col(VALUE).alias("actual"))
    orders = order_table(observations.sparkSession, {"temperature": [TEMPERATURE_ORDER],
                                                     "precipitation": [PRECIPITATION_ORDER]})
    holdout = cut_lineage(fit_forecast(train, orders, n_test)).join(test, [SERIES, MONTH], "left")
    mse = score(holdout.withColumnRenamed("yhat", "predicted").where(F.col("actual").isNotNull()))
    long_range = fit_forecast(train, orders, horizon)
    celsius = F.when(F.col(SERIES) == "temperature", fahrenheit_to_celsius("yhat")).otherwise(F.col("yhat"))
    long_range = long_range.select(SERIES, MONTH, F.date_format(MONTH, "MMM-yy").alias("label"), "step",
                                   celsius.alias("yhat"))
    return ForecastResult(holdout, mse, long_range)
