"""Column expressions for station-day readings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the studied scripts).
# Precipitation attribute flag -> hours over which the amount was observed;
# a blank flag and a single-space flag both weigh 1.
FLAG_HOURS: dict[str, int] = {
    "A": 6, "B": 12, "C": 18, "D": 24, "E": 12, "F": 24, "G": 24, "H": 0, "I": 0, "": 1, " ": 1,
}
# Missing-value marks: precipitation 99.9 and snow depth 999.9 count as 0.
PRCP_MISSING: tuple[float, ...] = (99.9,)
SNOW_MISSING: tuple[float, ...] = (999.9,)


def flag_hours(flag: Column | str, weights: Mapping[str, int] = FLAG_HOURS) -> Column:
    """Hours for a flag; NULL for a flag outside ``weights``.

    The CSV reader turns an empty field into NULL and a quoted blank into
    ``' '``; both are looked up as the empty flag.
    """
    flag = F.col(flag) if isinstance(flag, str) else flag
    pairs = []
    for key, value in weights.items():
        pairs += [F.lit(key), F.lit(value)]
    return F.try_element_at(F.create_map(*pairs), F.coalesce(F.trim(flag), F.lit("")))


def zero_when_missing(value: Column | str, marks: Iterable[float]) -> Column:
    """0.0 where the reading carries a missing mark, else the reading."""
    value = F.col(value) if isinstance(value, str) else value
    marks = list(marks)
    if not marks:
        return value
    return F.when(value.isin(marks), F.lit(0.0)).otherwise(value)


def null_when_missing(value: Column | str, marks: Iterable[float]) -> Column:
    """NULL where the reading carries a missing mark (ignored by ``avg``)."""
    value = F.col(value) if isinstance(value, str) else value
    marks = list(marks)
    if not marks:
        return value
    return F.when(~value.isin(marks), value)


def weighted_precipitation(
    prcp: Column | str,
    hours: Column,
    prcp_missing: Iterable[float] = PRCP_MISSING,
) -> Column:
    """Amount times observation hours; a missing mark gives 0."""
    prcp = F.col(prcp) if isinstance(prcp, str) else prcp
    marks = list(prcp_missing)
    weighted = prcp * hours
    if not marks:
        return weighted
    return F.when(prcp.isin(marks), F.lit(0.0)).otherwise(weighted)


def fahrenheit_to_celsius(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return (value - F.lit(32.0)) * F.lit(5.0 / 9.0)
