"""Cleaning of station-day readings (one ``select``, no per-row Python)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.functions.weather import (
    FLAG_HOURS,
    PRCP_MISSING,
    SNOW_MISSING,
    flag_hours,
    null_when_missing,
    weighted_precipitation,
    zero_when_missing,
)

HOURS = "prcp_hours"


def with_flag_hours(df: DataFrame, weights: Mapping[str, int] = FLAG_HOURS,
                    flag: str = "prcp_flag") -> DataFrame:
    return df.withColumn(HOURS, flag_hours(flag, weights))


def clean_observations(
    df: DataFrame,
    weights: Mapping[str, int] = FLAG_HOURS,
    prcp_missing: Iterable[float] = PRCP_MISSING,
    snow_missing: Iterable[float] = SNOW_MISSING,
    temp_missing: Iterable[float] = (),
    require_coordinates: bool = False,
) -> DataFrame:
    """Readings with a known precipitation flag, plus derived measures.

    Adds ``year``, ``month`` (from ``obs_date``), ``temperature``,
    ``precipitation`` (amount x flag hours, a missing mark gives 0) and
    ``snow`` (a missing mark gives 0).  Rows whose flag is not in
    ``weights`` are left out here and returned by :func:`observation_rejects`.
    ``require_coordinates`` keeps only rows with both latitude and longitude
    (the yearly roll-up does, the monthly one does not).
    """
    out = with_flag_hours(df, weights).where(F.col(HOURS).isNotNull())
    if require_coordinates:
        out = out.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return out.withColumns({
        "year": F.year("obs_date"),
        "month": F.month("obs_date"),
        "temperature": null_when_missing("temp", temp_missing),
        "precipitation": weighted_precipitation("prcp", F.col(HOURS), prcp_missing),
        "snow": zero_when_missing("snow_depth", snow_missing),
    })


def observation_rejects(df: DataFrame, weights: Mapping[str, int] = FLAG_HOURS) -> DataFrame:
    """Readings whose precipitation flag has no weight (the studied job died on them)."""
    return with_flag_hours(df, weights).where(F.col(HOURS).isNull()).drop(HOURS)


def with_coordinates(df: DataFrame) -> DataFrame:
    """Rows with both latitude and longitude present."""
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
