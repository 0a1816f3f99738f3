import datetime as dt

import pytest

from terrapanel.operators.clean import clean_observations, observation_rejects
from terrapanel.operators.panel import (
    country_year,
    country_year_via_stations,
    drop_incomplete_years,
    drop_short_first_year,
    month_series,
)

SCHEMA = ("station long, obs_date date, latitude double, longitude double, temp double, "
          "prcp double, prcp_flag string, snow_depth double, country_code string")
D = dt.date(1960, 3, 1)


def _obs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_flag_weights(spark):
    flags = ["A", "B", "C", "D", "E", "F", "G", "H", "I", "", " ", None]
    rows = [(i, D, 1.0, 1.0, 50.0, 0.5, f, 1.0, "X") for i, f in enumerate(flags)]
    got = {r.station: r.precipitation for r in clean_observations(_obs(spark, rows)).collect()}
    expected = [3, 6, 9, 12, 6, 12, 12, 0, 0, 0.5, 0.5, 0.5]
    assert [got[i] for i in range(len(flags))] == pytest.approx(expected)


def test_sentinels(spark):
    rows = [(1, D, 1.0, 1.0, 50.0, 99.9, "D", 999.9, "X"),
            (2, D, 1.0, 1.0, 50.0, 1.0, "A", 3.1, "X")]
    got = {r.station: (r.precipitation, r.snow) for r in clean_observations(_obs(spark, rows)).collect()}
    assert got[1] == (0.0, 0.0)
    assert got[2] == pytest.approx((6.0, 3.1))


def test_unknown_flag_is_rejected(spark):
    rows = [(1, D, 1.0, 1.0, 50.0, 1.0, "Z", 0.0, "X"), (2, D, 1.0, 1.0, 50.0, 1.0, "A", 0.0, "X")]
    df = _obs(spark, rows)
    assert [r.station for r in observation_rejects(df).collect()] == [1]
    assert [r.station for r in clean_observations(df).collect()] == [2]


def test_blank_coordinates(spark):
    rows = [(1, D, None, 1.0, 50.0, 0.0, "A", 0.0, "X"), (2, D, 1.0, 1.0, 50.0, 0.0, "A", 0.0, "X")]
    df = _obs(spark, rows)
    assert clean_observations(df, require_coordinates=True).count() == 1
    assert clean_observations(df).count() == 2


def test_year_rollup(spark):
    # (temp, prcp, snow): (10, 0, 1) and (20, 6, 2) with flag weight 1 -> mean 15, mean 3, total 3
    rows = [(1, D, 1.0, 1.0, 10.0, 0.0, "", 1.0, "X"), (1, D, 1.0, 1.0, 20.0, 6.0, "", 2.0, "X")]
    r = country_year(clean_observations(_obs(spark, rows))).collect()[0]
    assert (r.temperature, r.precipitation, r.snow, r.n_obs) == (15.0, 3.0, 3.0, 2)


def test_station_preaggregation_equals_rowwise(spark):
    rows = []
    for st in range(6):
        for day in range(40):
            rows.append((st, dt.date(1960 + day % 3, 1 + day % 12, 1), None if st == 5 else 1.0 * st,
                         2.0, 30.0 + st + day, 0.1 * (day % 7), "ABCDEFGHI "[day % 10], 0.5 * (day % 4),
                         "C%d" % (st % 2)))
    df = _obs(spark, rows)
    stations = df.select("station", "latitude", "longitude", "country_code").distinct()
    days = df.drop("latitude", "longitude", "country_code")
    fast = country_year_via_stations(clean_observations(days), stations)
    slow = country_year(clean_observations(df, require_coordinates=True))
    a = sorted((r.country_code, r.year, round(r.temperature, 9), round(r.precipitation, 9), r.snow, r.n_obs)
               for r in fast.collect())
    b = sorted((r.country_code, r.year, round(r.temperature, 9), round(r.precipitation, 9), r.snow, r.n_obs)
               for r in slow.collect())
    assert a == b


def test_drop_incomplete_years(spark):
    rows = [(1929, m, 1.0, 1.0, 1) for m in range(6, 13)] + [(1930, m, 1.0, 1.0, 1) for m in range(1, 13)]
    monthly = spark.createDataFrame(rows, "year int, month int, temperature double, precipitation double, n_obs long")
    kept = drop_incomplete_years(monthly).select("year").distinct().collect()
    assert [r.year for r in kept] == [1930]


def test_only_the_first_year_is_dropped(spark):
    rows = [(y, m, 1.0, 1.0, 1) for y, months in ((1929, 7), (1930, 12), (1931, 5)) for m in range(1, months + 1)]
    schema = "year int, month int, temperature double, precipitation double, n_obs long"
    monthly = spark.createDataFrame(rows, schema)
    assert {r.year for r in drop_short_first_year(monthly).collect()} == {1930, 1931}
    assert drop_short_first_year(monthly.where("year > 1929")).count() == 17
    assert drop_short_first_year(spark.createDataFrame([], schema)).count() == 0


def test_month_series_keeps_blank_coordinates(spark):
    rows = [(1, dt.date(1960, 1, 5), None, None, 10.0, 0.0, "A", 0.0, "X"),
            (2, dt.date(1960, 1, 6), 1.0, 1.0, 20.0, 0.0, "A", 0.0, "X")]
    r = month_series(clean_observations(_obs(spark, rows))).collect()[0]
    assert (r.year, r.month, r.temperature, r.n_obs) == (1960, 1, 15.0, 2)


def test_hot_station_rolls_up_through_partial_sums(spark):
    import io
    from contextlib import redirect_stdout

    # station 0 holds a third of all readings
    rows = [(0, dt.date(1960, 1 + i % 12, 1 + i % 28), 1.0, 1.0, 40.0 + i % 7, 0.1 * (i % 5), "A", 0.0, "HOT")
            for i in range(600)]
    rows += [(1 + i % 40, dt.date(1960, 1 + i % 12, 1), 2.0, 2.0, 50.0 + i % 3, 0.2, "B", 1.0, "C%d" % (i % 4))
             for i in range(1200)]
    df = _obs(spark, rows)
    stations = df.select("station", "latitude", "longitude", "country_code").distinct()
    days = df.drop("latitude", "longitude", "country_code")
    fast = country_year_via_stations(clean_observations(days), stations)
    slow = country_year(clean_observations(df, require_coordinates=True))
    key = lambda r: (r.country_code, r.year, round(r.temperature, 9), round(r.precipitation, 9), r.n_obs)
    assert sorted(map(key, fast.collect())) == sorted(map(key, slow.collect()))
    buf = io.StringIO()
    with redirect_stdout(buf):
        fast.explain()
    plan = buf.getvalue()
    # the readings reach their exchange on (station, year) only as partial sums
    import re
    m = re.search(r"Exchange hashpartitioning\(station#\d+L?, year#\d+", plan)
    assert m is not None
    below = plan[m.end():].split("Exchange", 1)[0]
    assert "partial_sum(temperature" in below
