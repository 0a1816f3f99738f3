"""Roll-ups of cleaned readings and the country/year panel join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MEASURES = ("temperature", "precipitation", "snow")


def _partial_sums(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("temperature").alias("_sum_t"), F.count("temperature").alias("_n_t"),
        F.sum("precipitation").alias("_sum_p"), F.count("precipitation").alias("_n_p"),
        F.sum("snow").alias("_sum_s"), F.count(F.lit(1)).alias("_n"),
    )


def _finish(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        (F.sum("_sum_t") / F.sum("_n_t")).alias("temperature"),
        (F.sum("_sum_p") / F.sum("_n_p")).alias("precipitation"),
        F.sum("_sum_s").alias("snow"),
        F.sum("_n").alias("n_obs"),
    )


def country_year(clean: DataFrame, key: str = "country_code") -> DataFrame:
    """Mean temperature, mean precipitation, total snow and reading count per (key, year)."""
    return clean.groupBy(key, "year").agg(
        F.avg("temperature").alias("temperature"),
        F.avg("precipitation").alias("precipitation"),
        F.sum("snow").alias("snow"),
        F.count(F.lit(1)).alias("n_obs"),
    )


def station_year_sums(clean_days: DataFrame) -> DataFrame:
    """Partial sums per (station, year): the one pass over readings that every yearly roll-up shares.

    Map-side combined, so a station holding a third of all rows costs one
    partial row per task.
    """
    return _partial_sums(clean_days, ["station", "year"])


def rollup_station_sums(
    sums: DataFrame,
    stations: DataFrame,
    key: str = "country_code",
    require_coordinates: bool = True,
) -> DataFrame:
    """Finish :func:`station_year_sums` into per (key, year) means, total snow and counts."""
    st = stations
    if require_coordinates:
        st = st.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _finish(sums.join(st.select("station", key), "station"), [key, "year"])


def country_year_via_stations(
    clean_days: DataFrame,
    stations: DataFrame,
    key: str = "country_code",
    require_coordinates: bool = True,
) -> DataFrame:
    """:func:`country_year` for readings whose country lives on a station table.

    Readings are first summed per (station, year) and only those partial
    sums meet the station table: the join input shrinks from |readings| to
    |stations| x |years| before anything is shuffled by country, and the
    result equals the row-level roll-up exactly (sums of sums; means as
    total / count).
    """
    return rollup_station_sums(station_year_sums(clean_days), stations, key, require_coordinates)


def country_year_geocoded(sums: DataFrame, stations: DataFrame, codes: DataFrame) -> DataFrame:
    """Per (country, year) roll-up with the country resolved from each station's coordinates.

    ``sums`` comes from :func:`station_year_sums`; ``codes`` maps distinct
    (latitude, longitude) to ``country_code`` (see
    :func:`terrapanel.operators.geo.geocode`).
    """
    st = stations.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    joined = (sums.join(st.select("station", "latitude", "longitude"), "station")
              .join(codes.select("latitude", "longitude", "country_code"), ["latitude", "longitude"]))
    return _finish(joined, ["country_code", "year"])


def position_year_sums(clean: DataFrame) -> DataFrame:
    """Partial sums per (latitude, longitude, year): the one pass over located readings.

    Keyed by the position of each reading, not of its station, so a station that moved counts
    where it stood and readings without a position count nowhere.
    """
    located = clean.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return _partial_sums(located, ["latitude", "longitude", "year"])


def country_year_by_position(sums: DataFrame, codes: DataFrame) -> DataFrame:
    """Finish :func:`position_year_sums` per (country, year); ``codes`` as from :func:`~terrapanel.operators.geo.geocode`."""
    joined = sums.join(codes.select("latitude", "longitude", "country_code"), ["latitude", "longitude"])
    return _finish(joined, ["country_code", "year"])


def month_series(clean: DataFrame) -> DataFrame:
    """Mean temperature and precipitation per (year, month) over all readings."""
    return clean.groupBy("year", "month").agg(
        F.avg("temperature").alias("temperature"),
        F.avg("precipitation").alias("precipitation"),
        F.count(F.lit(1)).alias("n_obs"),
    )


def drop_incomplete_years(monthly: DataFrame, min_months: int = 12) -> DataFrame:
    """Drop years with fewer than ``min_months`` months (e.g. a partial first year).

    The count is a window per year: groups hold at most twelve rows.
    """
    per_year = Window.partitionBy("year")
    return (monthly.withColumn("_months", F.count(F.lit(1)).over(per_year))
            .where(F.col("_months") >= min_months).drop("_months"))


def drop_short_first_year(monthly: DataFrame, min_months: int = 12) -> DataFrame:
    """Drop the first year of the series if it has fewer than ``min_months`` months; later short years stay."""
    first = monthly.select(F.min("year")).scalar()
    months = F.count(F.lit(1)).over(Window.partitionBy("year"))
    return (monthly.withColumn("_months", months)
            .where((F.col("year") != first) | (F.col("_months") >= min_months)).drop("_months"))


def build_panel(
    base: DataFrame,
    *indicators: DataFrame,
    on: Sequence[str] = ("country_code", "year"),
    how: str = "inner",
) -> DataFrame:
    """Join yearly indicator tables onto the weather roll-up by (country, year).

    All inputs are keyed by the same columns, so after the first shuffle the
    later joins reuse the hash partitioning (or run as broadcasts when AQE
    measures a side as small).
    """
    keys = list(on)
    return reduce(lambda left, right: left.join(right, keys, how), indicators, base)
