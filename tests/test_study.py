"""The three analyses end to end on the fixture tables."""

from pyspark.sql import functions as F

from terrapanel.plans.study import country_betas, country_panel, hypothesis_tests, monthly_forecast
from terrapanel.sources import tables
from tests.conftest import SF01


def _panel(spark):
    iso = tables.iso_codes(spark, SF01)
    ind = tables.indicators(spark, SF01).join(iso, F.col("country_code") == iso.alpha_2).select(
        F.col("alpha_3").alias("country_code"), "year", "co2", "energy", "population")
    return country_panel(
        tables.observations(spark, SF01), tables.gazetteer(spark, SF01), iso,
        ind.select("country_code", "year", "co2"), ind.select("country_code", "year", "energy"),
        ind.select("country_code", "year", "population"))


def test_hypothesis_and_betas(spark):
    panel = _panel(spark)
    n, c, y = panel.count(), panel.select("country_code").distinct().count(), panel.select("year").distinct().count()
    assert n > 0
    res = hypothesis_tests(panel)
    assert res.coefficients.count() == 2 * (1 + (c - 1) + (y - 1) + 3)
    tests = res.tests.collect()
    assert len(tests) == 6 and all(r.decision in ("accept", "reject") for r in tests)
    assert all(r.dof == n - 8 for r in tests)
    assert res.predictions.count() == n
    betas = country_betas(panel)
    assert betas.betas.count() == c
    assert betas.top_by_co2_beta.count() == min(10, c)
    assert betas.most_emitting.count() == min(10, c)


def test_panel_places_each_reading_by_its_own_position(spark):
    """A blank position counts nowhere, and a station that moved counts in both countries."""
    obs = spark.createDataFrame(
        [("s1", "1990-01-01", 10.0, 10.0, 50.0), ("s1", "1990-01-02", None, None, 90.0),
         ("s2", "1990-01-01", 10.0, 10.0, 60.0), ("s2", "1990-01-02", -40.0, -70.0, 20.0)],
        "station string, obs_date string, latitude double, longitude double, temp double",
    ).selectExpr("station", "to_date(obs_date) obs_date", "latitude", "longitude", "temp",
                 "1.0D prcp", "'A' prcp_flag", "0.0D snow_depth")
    places = spark.createDataFrame([(1, 11.0, 10.0, "AA"), (2, -41.0, -70.0, "BB")],
                                   "place_id long, latitude double, longitude double, cc string")
    iso = spark.createDataFrame([("AA", "AAA"), ("BB", "BBB")], "alpha_2 string, alpha_3 string")

    def indicator(name, value):
        return spark.createDataFrame([("AAA", 1990, value), ("BBB", 1990, value)], f"country_code string, year int, {name} double")

    seen = spark.sparkContext.accumulator(0)
    schema = obs.schema

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    panel = country_panel(obs.mapInPandas(count, schema), places, iso, indicator("co2", 1.0),
                          indicator("energy", 2.0), indicator("population", 3.0))
    assert {r.country_code: r.temperature for r in panel.collect()} == {"AAA": 55.0, "BBB": 20.0}
    assert seen.value == 4  # the readings are read once


def test_monthly_forecast(spark):
    res = monthly_forecast(tables.observations(spark, SF01), 72, 10, horizon=24)
    hold = res.holdout.collect()
    assert len(hold) == 20 and all(r.actual is not None for r in hold)
    assert res.holdout_mse.count() == 2
    assert res.long_range.count() == 48
