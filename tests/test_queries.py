"""Every registered query against its SQL statement on DuckDB (the correctness gate)."""

import pytest

from terrapanel.plans.catalog import QUERIES
from tests.compare import compare
from tests.conftest import SF001, SF01


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["country_code", "year", "temperature", "precipitation", "co2", "energy",
                          "population"]


def test_every_query_has_sql_or_is_a_model_fit():
    from __spark_entry__ import oracle_sql, queries

    without = set(QUERIES) - set(oracle_sql())
    assert set(QUERIES) <= set(queries())
    assert without == {"seasonal_arima_forecast", "sarima_holdout_mse", "forecast_long_range", "order_grid_rank"}


@pytest.mark.parametrize("sf_dir", [SF01, SF001])
def test_queries_match_sql(spark, sf_dir):
    report = compare(spark, sf_dir, list(QUERIES), verbose=False)
    bad = {k: v for k, v in report.items() if not (v.startswith("OK") or "no oracle" in v)}
    assert not bad, bad
