"""Named queries over the shared tables: one per operator of the study.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; shared stages below it are materialised when it is called.  Output
columns are aliased to match the SQL checks in :mod:`terrapanel.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrapanel.functions.weather import fahrenheit_to_celsius
from terrapanel.operators.arma_start import arma_start
from terrapanel.operators.clean import clean_observations, observation_rejects, with_coordinates
from terrapanel.operators.geo import country_codes, nearest_place
from terrapanel.operators.indicators import (
    PERIOD,
    clean_indicator,
    knn_fill,
    min_present,
    pair_distances,
    to_cells,
    value_columns,
    wide_to_long,
)
from terrapanel.operators import long_series, rollup_store
from terrapanel.operators.mapout import cell_pyramid, code_merge, emission_class, grid_cells, point_features, popup_text
from terrapanel.operators.panel import (
    country_year,
    country_year_geocoded,
    drop_incomplete_years,
    drop_short_first_year,
    month_series,
    rollup_station_sums,
    station_year_sums,
)
from terrapanel.operators.rank import bottom_k, members_of, position_slice, top_k
from terrapanel.operators.regress import (
    POOLED_FACTORS,
    POOLED_TARGETS,
    group_betas,
    PooledFit,
    fit_pooled,
    pooled_effects,
    pooled_predictions,
    ridge_fit,
    ridge_predictions,
    ridge_tests,
)
from terrapanel.operators.sarima import Order
from terrapanel.operators.series import (
    LONG_HORIZON,
    MONTH,
    PRECIPITATION_ORDER,
    SERIES,
    TEMPERATURE_ORDER,
    VALUE,
    fit_forecast,
    lag_features,
    month_axis,
    monthly_long,
    order_table,
    score,
    seasonal_difference,
    seasonal_naive,
    split_by_date,
    split_by_position,
)
from terrapanel.operators.stats import corr_sql, moments, zscore_by, zscore_global
from terrapanel.plans.common import (
    avg_co2,
    clean_days,
    input_state,
    panel,
    shared,
    station_day_files,
    station_sums,
    tidy,
    weather_by_country_year,
)
from terrapanel.plans.study import country_panel
from terrapanel.session import checkpoint_dir
from terrapanel.sources import files, layout, tables, versions
from terrapanel.streaming.rollup import run_country_year_stream

Query = Callable[[SparkSession, str], DataFrame]
TOP_N = 10
SLICE = (15, 25)
IND_IDS = files.WIDE_IDS
IND_DROP = ["Indicator Name", "Indicator Code"]
IND_ENTITY = "Country Code"
IND_VALUE = "OrderValue"
# Present cells a row needs (ids included) out of 4 ids + 7 years.
IND_MIN_CELLS = 9
KNN_K = 2
# Positional split of the monthly series: six whole years to train on, then
# the following ten months held out (the final, partial month is left out).
N_TRAIN, N_TEST = 72, 10
# The same split by calendar: train through Dec 2000, test Jan-Oct 2001.
TRAIN_END, TEST_END = "2000-12-01", "2001-10-01"
# Share of the readings that train, by date.
TRAIN_PERCENT = 80
# Candidate orders of the model search, per series (the chosen ones included).
ORDER_GRID = {
    "temperature": [TEMPERATURE_ORDER, Order(1, 1, 1, 1, 1, 1, 12), Order(0, 1, 1, 0, 1, 1, 12)],
    "precipitation": [PRECIPITATION_ORDER, Order(1, 1, 1, 1, 1, 1, 12), Order(0, 1, 1, 0, 1, 1, 12)],
}
# Order value that counts as one unit of emission of a place.
PLACE_UNIT = 25_000.0
# Marker clustering cell, degrees.
CLUSTER_DEG = 30.0
PANEL_MEASURES = ["temperature", "precipitation", "co2", "energy", "population"]


# --- cleaning and roll-ups -------------------------------------------------

def obs_clean(spark: SparkSession, sf: str) -> DataFrame:
    df = clean_observations(tables.observations(spark, sf))
    return tidy(df.select("station", "obs_date", "country_code", "year", "month",
                          "temperature", "precipitation", "snow"))


def obs_with_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    df = with_coordinates(tables.observations(spark, sf))
    return tidy(df.select("station", "obs_date", "latitude", "longitude"))


def obs_rejects(spark: SparkSession, sf: str) -> DataFrame:
    # Rejects need no station attributes: no join with the station table.
    df = observation_rejects(tables.station_days(spark, sf))
    return tidy(df.select("station", "obs_date", "prcp_flag"))


def flag_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Readings whose flag (here the return flag, N and R have no hours) is unknown."""
    li = tables.table(spark, sf, "lineitem")
    days = tables.station_days_from(li.withColumn("_flag", F.col("l_returnflag")), flag="_flag")
    return tidy(observation_rejects(days).select("station", "obs_date", "prcp_flag", "temp"))


def csv_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Good records of the raw station-day files."""
    obs = files.read_observations(spark, station_day_files(spark, sf))
    return tidy(obs.withColumn("prcp_flag", F.coalesce(F.trim("prcp_flag"), F.lit(""))))


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed records of the raw station-day files, with their reasons."""
    return tidy(files.read_observation_rejects(spark, station_day_files(spark, sf)))


def csv_country_year(spark: SparkSession, sf: str) -> DataFrame:
    """Country/year weather from the raw files; malformed records don't count."""
    obs = files.read_observations(spark, station_day_files(spark, sf)).withColumn("station", F.col("station").try_cast("long"))
    sums = station_year_sums(clean_observations(obs, require_coordinates=True))
    return tidy(rollup_station_sums(sums, tables.stations(spark, sf)))


def csv_indicator_long(spark: SparkSession, sf: str) -> DataFrame:
    """The wide indicator file, filtered and stacked, written as a long file and read back."""
    root = f"{checkpoint_dir(spark)}/indicator-{uuid4().hex}"
    files.write_csv(_wide(spark, sf), f"{root}/wide")
    wide = min_present(files.read_indicator_wide(spark, f"{root}/wide"), IND_MIN_CELLS).drop(*IND_DROP)
    files.write_csv(wide_to_long(wide, ["Country Name", "Country Code"], IND_VALUE), f"{root}/long")
    return tidy(files.read_indicator_long(spark, f"{root}/long", IND_VALUE))


def rollup_store_series(spark: SparkSession, sf: str) -> DataFrame:
    """Country/year and month series of the raw files from one stored roll-up, built in two updates."""
    raw = station_day_files(spark, sf)
    root = f"{checkpoint_dir(spark)}/rollup-{uuid4().hex}"
    rollup_store.update(spark, root, raw.replace("/*/", "/whole/", 1))
    sums = rollup_store.sums_of(spark, rollup_store.update(spark, root, raw).folder)
    by_name = tables.stations(spark, sf).withColumn("station", F.col("station").cast("string"))
    years = rollup_store.country_years(sums, by_name).withColumn("grain", F.lit("country_year"))
    months = rollup_store.months(sums).withColumn("grain", F.lit("month"))
    return tidy(years.unionByName(months, allowMissingColumns=True))


def bucketed_country_month(spark: SparkSession, sf: str) -> DataFrame:
    """Weather per (country, year, month) from readings bucketed as the station list is: no exchange of readings at the join."""
    listing = versions.input_files(spark, f"{sf}/lineitem.parquet")
    name = f"terrapanel_{versions.input_key(listing)[:16]}_{uuid4().hex[:8]}"
    readings = clean_days(spark, sf).select("station", "year", "month", "temperature", "precipitation", "snow")
    years = readings.agg(F.count_distinct("year")).first()[0]
    layout.write_layout(readings, _located_stations(spark, sf), name, f"{checkpoint_dir(spark)}/{name}", layout.bucket_count(listing, years))
    located = layout.located_readings(spark, name)
    return tidy(located.groupBy("country_code", "year", "month").agg(
        F.avg("temperature").alias("temperature"), F.avg("precipitation").alias("precipitation"),
        F.sum("snow").alias("snow"), F.count(F.lit(1)).alias("n_obs")))


def country_year_means(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(weather_by_country_year(spark, sf))


def country_year_rowwise(spark: SparkSession, sf: str) -> DataFrame:
    """Same roll-up straight from joined rows (the plan without station pre-aggregation)."""
    clean = clean_observations(tables.observations(spark, sf), require_coordinates=True)
    return tidy(country_year(clean))


def month_year_means(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(month_series(clean_days(spark, sf)))


def series_drop_year(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drop_incomplete_years(_monthly(spark, sf)))


def series_drop_first_year(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drop_short_first_year(_monthly(spark, sf)))


def panel_join(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(panel(spark, sf))


# --- rankings ---------------------------------------------------------------

def avg_co2_by_country(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(avg_co2(spark, sf))


def least_emitting_10(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(bottom_k(avg_co2(spark, sf), "avg_co2", TOP_N, tie=["country_code"]))


def most_emitting_10(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(top_k(avg_co2(spark, sf), "avg_co2", TOP_N, tie=["country_code"]))


def position_slice_q(spark: SparkSession, sf: str) -> DataFrame:
    start, stop = SLICE
    return tidy(position_slice(avg_co2(spark, sf), "avg_co2", start, stop, tie=["country_code"]))


def most_emitting_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: the panel rows (yearly weather and indicators) of the ten highest emitters."""
    top = top_k(avg_co2(spark, sf), "avg_co2", TOP_N, tie=["country_code"])
    return tidy(members_of(panel(spark, sf), top, "country_code"))


# --- per-country models -----------------------------------------------------

def group_zscores(spark: SparkSession, sf: str) -> DataFrame:
    z = zscore_by(panel(spark, sf), PANEL_MEASURES, ["country_code"])
    return tidy(z.select("country_code", "year", *[f"z_{c}" for c in PANEL_MEASURES]))


def group_moments(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(moments(panel(spark, sf), PANEL_MEASURES, ["country_code"]))


def group_betas_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(group_betas(panel(spark, sf)))


def top_betas_10(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(top_k(group_betas(panel(spark, sf)), "co2", TOP_N, tie=["country_code"]))


def most_emitting_betas(spark: SparkSession, sf: str) -> DataFrame:
    top = top_k(avg_co2(spark, sf), "avg_co2", TOP_N, tie=["country_code"])
    betas = members_of(group_betas(panel(spark, sf)), top, "country_code")
    return tidy(top_k(betas, "co2", TOP_N, tie=["country_code"]))


def least_emitting_betas(spark: SparkSession, sf: str) -> DataFrame:
    low = bottom_k(avg_co2(spark, sf), "avg_co2", TOP_N, tie=["country_code"])
    betas = members_of(group_betas(panel(spark, sf)), low, "country_code")
    return tidy(top_k(betas, "co2", TOP_N, tie=["country_code"]))


def group_betas_min_norm(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficients of every group; where factors depend on each other the smallest least-squares solution."""
    return tidy(group_betas(panel(spark, sf), rank_deficient="min_norm"))


# --- pooled model -----------------------------------------------------------

def global_zscores(spark: SparkSession, sf: str) -> DataFrame:
    z = zscore_global(panel(spark, sf), PANEL_MEASURES)
    return tidy(z.select("country_code", "year", *[f"z_{c}" for c in PANEL_MEASURES]))


def dummy_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse drop-first dummies: one row per (panel row, active dummy column)."""
    p = panel(spark, sf).select("country_code", "year")
    base_cc = p.select(F.min("country_code")).scalar()
    base_year = p.select(F.min("year")).scalar()
    cc = p.where(F.col("country_code") != base_cc).select(
        "country_code", "year", F.concat(F.lit("CC_"), "country_code").alias("dummy"))
    yr = p.where(F.col("year") != base_year).select(
        "country_code", "year", F.concat(F.lit("YEAR_"), F.col("year").cast("string")).alias("dummy"))
    return tidy(cc.unionByName(yr).withColumn("value", F.lit(1).cast("long")))


def gram_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Entries of X'X and X'y for the z-scored three-factor design with a bias column."""
    cols = list(POOLED_TARGETS) + list(POOLED_FACTORS)
    design = ["bias"] + list(POOLED_FACTORS)
    m = moments(panel(spark, sf), cols)
    rows = []
    for i, a in enumerate(design):
        for b in design[i:] + list(POOLED_TARGETS):
            if a == "bias" and b == "bias":
                val = "CAST(n AS DOUBLE)"
            elif a == "bias" or b == "bias":
                val = "CAST(0 AS DOUBLE)"
            else:
                val = f"n * {corr_sql(a, b, cols)}"
            rows.append(F.struct(F.lit(a).alias("row_term"), F.lit(b).alias("col_term"),
                                 F.expr(val).alias("value")))
    return tidy(m.select(F.inline(F.array(*rows))))


def ridge_three_factor(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(ridge_fit(panel(spark, sf)))


def ridge_predictions_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(ridge_predictions(panel(spark, sf)))


def ridge_tests_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(ridge_tests(panel(spark, sf)))


_POOLED: dict[str, PooledFit] = {}


def _pooled(spark: SparkSession, sf: str) -> PooledFit:
    """One fixed-effects solve per session and input, shared by its result tables."""
    key = input_state(spark, sf)
    if key not in _POOLED:
        _POOLED[key] = fit_pooled(panel(spark, sf))
    return _POOLED[key]


def pooled_effects_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(pooled_effects(panel(spark, sf), fit=_pooled(spark, sf))[0])


def pooled_effects_tests(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(pooled_effects(panel(spark, sf), fit=_pooled(spark, sf))[1])


# --- indicators -------------------------------------------------------------

def _wide(spark: SparkSession, sf: str) -> DataFrame:
    return shared(spark, sf, "indicator_wide", lambda: tables.indicator_wide(spark, sf))


def _kept_wide(spark: SparkSession, sf: str) -> DataFrame:
    return min_present(_wide(spark, sf), IND_MIN_CELLS)


def indicator_min_present(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_kept_wide(spark, sf))


def indicator_pair_distance(spark: SparkSession, sf: str) -> DataFrame:
    wide = _kept_wide(spark, sf)
    n = len(value_columns(wide, IND_IDS))
    d = pair_distances(to_cells(wide, IND_IDS), IND_ENTITY, n)
    return tidy(d.select(F.col("a").alias("code_a"), F.col("b").alias("code_b"), "n_shared", "distance"))


def indicator_knn_imputed(spark: SparkSession, sf: str) -> DataFrame:
    wide = _kept_wide(spark, sf)
    n = len(value_columns(wide, IND_IDS))
    fill = knn_fill(to_cells(wide, IND_IDS), IND_ENTITY, n, KNN_K)
    return tidy(fill.select(IND_ENTITY, F.col(PERIOD).alias("Year"),
                            F.col("imputed").alias(IND_VALUE), "n_donors"))


def indicator_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = _wide(spark, sf).drop(*IND_DROP)
    return tidy(wide_to_long(wide, ["Country Name", "Country Code"], IND_VALUE))


def indicator_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    wide = _wide(spark, sf)
    return tidy(clean_indicator(wide, IND_IDS, IND_ENTITY, IND_VALUE, IND_MIN_CELLS, KNN_K,
                                drop=IND_DROP))


# --- monthly series and forecasts ------------------------------------------

def _monthly(spark: SparkSession, sf: str) -> DataFrame:
    return shared(spark, sf, "monthly", lambda: month_series(clean_days(spark, sf)))


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return monthly_long(_monthly(spark, sf))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return split_by_position(_series(spark, sf), N_TRAIN, N_TEST)


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_split(spark, sf).select(SERIES, MONTH, VALUE, "position", "split"))


def train_test_split_by_date(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(split_by_date(_series(spark, sf), TRAIN_END, TEST_END).select(SERIES, MONTH, VALUE, "split"))


def seasonal_difference_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(seasonal_difference(_series(spark, sf)).select(SERIES, MONTH, VALUE, "diff"))


def lag_features_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(lag_features(_series(spark, sf)))


def reading_lags(spark: SparkSession, sf: str) -> DataFrame:
    """All readings as one series by date: position, split, and the temperature 1, 12 and 13 readings before."""
    li = tables.table(spark, sf, "lineitem")
    # Order and line number don't tell all readings apart; with these only equal readings tie.
    line = ["obs_date", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", VALUE]
    series = li.select(F.to_date("l_shipdate").alias("obs_date"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       F.lit("temperature").alias(SERIES), (F.col("l_quantity") + 30.0).alias(VALUE))
    numbered = long_series.number_rows(series, [SERIES], line)
    split = long_series.split_by_share(numbered, [SERIES], TRAIN_PERCENT)
    return tidy(long_series.lags(split, [SERIES], VALUE, (1, 12, 13)).drop(SERIES, "l_partkey", "l_suppkey"))


def month_axis_q(spark: SparkSession, sf: str) -> DataFrame:
    li = tables.table(spark, sf, "lineitem")
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("start"),
                    F.max(F.to_date("l_shipdate")).alias("end"))
    return tidy(month_axis(bounds))


def fahrenheit_to_celsius_q(spark: SparkSession, sf: str) -> DataFrame:
    m = _monthly(spark, sf)
    return tidy(m.select("year", "month", fahrenheit_to_celsius("temperature").alias("temperature_c")))


def holdout_compare(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(seasonal_naive(_split(spark, sf)))


def holdout_mse(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(score(seasonal_naive(_split(spark, sf))))


def _chosen_orders(spark: SparkSession) -> DataFrame:
    return order_table(spark, {"temperature": [TEMPERATURE_ORDER],
                               "precipitation": [PRECIPITATION_ORDER]})


def arma_start_q(spark: SparkSession, sf: str) -> DataFrame:
    train = _split(spark, sf).where(F.col("split") == "train")
    return tidy(arma_start(train, order_table(spark, ORDER_GRID)))


def _holdout_forecast(spark: SparkSession, sf: str, orders: DataFrame, key: str) -> DataFrame:
    split = _split(spark, sf)
    train = split.where(F.col("split") == "train")
    test = split.where(F.col("split") == "test").select(SERIES, MONTH, F.col(VALUE).alias("actual"))
    fc = shared(spark, sf, f"fits_{key}", lambda: fit_forecast(train, orders, N_TEST))
    return fc.join(test, [SERIES, MONTH], "left")


def seasonal_arima_forecast(spark: SparkSession, sf: str) -> DataFrame:
    fc = _holdout_forecast(spark, sf, _chosen_orders(spark), "chosen")
    return tidy(fc.select(SERIES, "order_label", MONTH, "step", "yhat", "actual", "sigma2", "converged"))


def sarima_holdout_mse(spark: SparkSession, sf: str) -> DataFrame:
    fc = _holdout_forecast(spark, sf, _chosen_orders(spark), "chosen").withColumnRenamed("yhat", "predicted")
    return tidy(score(fc.where(F.col("actual").isNotNull()), keys=["order_label"]))


def forecast_long_range(spark: SparkSession, sf: str) -> DataFrame:
    split = _split(spark, sf)
    train = split.where(F.col("split") == "train")
    fc = fit_forecast(train, _chosen_orders(spark), LONG_HORIZON)
    yhat = F.when(F.col(SERIES) == "temperature", fahrenheit_to_celsius("yhat")).otherwise(F.col("yhat"))
    return tidy(fc.select(SERIES, MONTH, F.date_format(MONTH, "MMM-yy").alias("label"), "step",
                          yhat.alias("yhat")))


def order_grid_rank(spark: SparkSession, sf: str) -> DataFrame:
    fc = _holdout_forecast(spark, sf, order_table(spark, ORDER_GRID), "grid").withColumnRenamed("yhat", "predicted")
    scored = score(fc.where(F.col("actual").isNotNull()), keys=["order_label", "converged"])
    w = Window.partitionBy(SERIES).orderBy(F.col("converged").desc(), F.col("mse").asc_nulls_last(), "order_label")
    return tidy(scored.withColumn("rank", F.row_number().over(w)))


# --- coordinates to countries ----------------------------------------------

def _located_stations(spark: SparkSession, sf: str) -> DataFrame:
    return with_coordinates(tables.stations(spark, sf))


def distinct_coordinates(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct station coordinates with their reading counts (counted per station first)."""
    per_station = station_sums(spark, sf).groupBy("station").agg(F.sum("_n").alias("_n"))
    located = per_station.join(_located_stations(spark, sf), "station")
    return tidy(located.groupBy("latitude", "longitude").agg(F.sum("_n").alias("n_obs")))


def _nearest(spark: SparkSession, sf: str) -> DataFrame:
    return shared(spark, sf, "nearest_place", lambda: nearest_place(
        _located_stations(spark, sf), tables.gazetteer(spark, sf)))


def nearest_place_country(spark: SparkSession, sf: str) -> DataFrame:
    near = _nearest(spark, sf)
    return tidy(near.select("latitude", "longitude", "place_id", "cc", "distance_km"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    return country_codes(_nearest(spark, sf), tables.iso_codes(spark, sf))


def country_code_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_codes(spark, sf).select("latitude", "longitude", "country_code"))


def geo_country_year_means(spark: SparkSession, sf: str) -> DataFrame:
    out = country_year_geocoded(station_sums(spark, sf), tables.stations(spark, sf), _codes(spark, sf))
    return tidy(out)


def study_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The end-to-end panel: readings placed by their own position, three separate indicator tables."""
    iso = tables.iso_codes(spark, sf)

    def indicator(name: str) -> DataFrame:
        ind = tables.indicator_long(tables.indicators(spark, sf), name)
        return ind.join(iso, F.col("country_code") == F.col("alpha_2")).select(
            F.col("alpha_3").alias("country_code"), "year", name)

    return tidy(shared(spark, sf, "study_panel", lambda: country_panel(
        tables.observations(spark, sf), tables.gazetteer(spark, sf), iso,
        indicator("co2"), indicator("energy"), indicator("population"))))


def country_year_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The yearly roll-up computed incrementally by a streaming query."""
    return tidy(spark.read.parquet(run_country_year_stream(spark, sf)))


# --- map table ----------------------------------------------------------------

def _co2_per_country(spark: SparkSession, sf: str) -> DataFrame:
    return avg_co2(spark, sf).select(F.col("country_code").alias("code_3"), F.col("avg_co2").alias("co2"))


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return code_merge(tables.country_points(spark, sf), _co2_per_country(spark, sf))


def code_merge_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(_merged(spark, sf))


def emission_class_q(spark: SparkSession, sf: str) -> DataFrame:
    m = _merged(spark, sf)
    return tidy(m.select("code_3", "co2", emission_class("co2").alias("fill_color")))


def popup_text_q(spark: SparkSession, sf: str) -> DataFrame:
    m = _merged(spark, sf)
    return tidy(m.select("code_3", popup_text("Country", "co2").alias("popup")))


def point_features_q(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(point_features(_merged(spark, sf)))


def grid_cells_q(spark: SparkSession, sf: str) -> DataFrame:
    pts = point_features(_merged(spark, sf))
    return tidy(grid_cells(pts, CLUSTER_DEG))


def place_emission_class(spark: SparkSession, sf: str) -> DataFrame:
    """Class and popup of every place with orders, by its average order value (from sf0.01 on all three classes occur)."""
    orders = tables.table(spark, sf, "orders")
    value = orders.groupBy("o_custkey").agg((F.avg("o_totalprice") / PLACE_UNIT).alias("co2"))
    code = F.concat(F.lit(" P"), F.col("place_id").cast("string"))
    points = tables.gazetteer(spark, sf).select(code.alias("code_3"), F.col("cc").alias("Country"),
                                                F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"))
    merged = code_merge(points, value.select(F.concat(F.lit("P"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("code_3"), "co2"))
    return tidy(point_features(merged).select("code_3", "country", "latitude", "longitude", "fill_color"))


def place_pyramid(spark: SparkSession, sf: str) -> DataFrame:
    """Groups of the known places at every zoom level of the map."""
    return tidy(cell_pyramid(tables.gazetteer(spark, sf)))


def pooled_effects_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(pooled_predictions(panel(spark, sf), fit=_pooled(spark, sf)))


QUERIES: dict[str, Query] = {
    "obs_clean": obs_clean,
    "obs_with_coordinates": obs_with_coordinates,
    "obs_rejects": obs_rejects,
    "flag_rejects": flag_rejects,
    "csv_observations": csv_observations,
    "csv_rejects": csv_rejects,
    "csv_country_year": csv_country_year,
    "csv_indicator_long": csv_indicator_long,
    "rollup_store_series": rollup_store_series,
    "bucketed_country_month": bucketed_country_month,
    "country_year_means": country_year_means,
    "country_year_rowwise": country_year_rowwise,
    "month_year_means": month_year_means,
    "series_drop_year": series_drop_year,
    "series_drop_first_year": series_drop_first_year,
    "panel_join": panel_join,
    "avg_co2_by_country": avg_co2_by_country,
    "least_emitting_10": least_emitting_10,
    "most_emitting_10": most_emitting_10,
    "position_slice": position_slice_q,
    "most_emitting_panel": most_emitting_panel,
    "group_zscores": group_zscores,
    "group_moments": group_moments,
    "group_betas": group_betas_q,
    "group_betas_min_norm": group_betas_min_norm,
    "top_betas_10": top_betas_10,
    "most_emitting_betas": most_emitting_betas,
    "least_emitting_betas": least_emitting_betas,
    "global_zscores": global_zscores,
    "dummy_columns": dummy_columns,
    "gram_entries": gram_entries,
    "ridge_three_factor": ridge_three_factor,
    "ridge_predictions": ridge_predictions_q,
    "ridge_tests": ridge_tests_q,
    "pooled_effects_coefficients": pooled_effects_coefficients,
    "pooled_effects_tests": pooled_effects_tests,
    "pooled_effects_predictions": pooled_effects_predictions,
    "indicator_min_present": indicator_min_present,
    "indicator_pair_distance": indicator_pair_distance,
    "indicator_knn_imputed": indicator_knn_imputed,
    "indicator_long": indicator_long,
    "indicator_cleaned": indicator_cleaned,
    "train_test_split": train_test_split,
    "train_test_split_by_date": train_test_split_by_date,
    "seasonal_difference": seasonal_difference_q,
    "lag_features": lag_features_q,
    "reading_lags": reading_lags,
    "month_axis": month_axis_q,
    "fahrenheit_to_celsius": fahrenheit_to_celsius_q,
    "holdout_compare": holdout_compare,
    "holdout_mse": holdout_mse,
    "arma_start": arma_start_q,
    "seasonal_arima_forecast": seasonal_arima_forecast,
    "sarima_holdout_mse": sarima_holdout_mse,
    "forecast_long_range": forecast_long_range,
    "order_grid_rank": order_grid_rank,
    "distinct_coordinates": distinct_coordinates,
    "nearest_place_country": nearest_place_country,
    "country_code_lookup": country_code_lookup,
    "geo_country_year_means": geo_country_year_means,
    "study_panel": study_panel,
    "country_year_stream": country_year_stream,
    "code_merge": code_merge_q,
    "emission_class": emission_class_q,
    "popup_text": popup_text_q,
    "point_features": point_features_q,
    "grid_cells": grid_cells_q,
    "place_pyramid": place_pyramid,
    "place_emission_class": place_emission_class,
}
