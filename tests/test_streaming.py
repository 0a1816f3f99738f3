"""The incremental roll-up resumes from its progress checkpoint."""

import os

from terrapanel.operators.clean import clean_observations
from terrapanel.operators.panel import country_year_via_stations
from terrapanel.sources import tables
from terrapanel.streaming.rollup import run_country_year_stream
from tests.conftest import SF001


def _rows(df):
    return sorted((r.country_code, r.year, round(r.temperature, 9), round(r.precipitation, 9), round(r.snow, 9), r.n_obs)
                  for r in df.collect())


def test_stream_matches_batch_and_resumes(spark, tmpdir_path):
    out, progress = os.path.join(tmpdir_path, "table"), os.path.join(tmpdir_path, "progress")
    run_country_year_stream(spark, SF001, out, progress)
    first = _rows(spark.read.parquet(out))
    batch = country_year_via_stations(clean_observations(tables.station_days(spark, SF001)),
                                      tables.stations(spark, SF001))
    assert first == _rows(batch)
    commits = sorted(os.listdir(os.path.join(progress, "commits")))
    # Restart on the same progress folder: nothing new to read, result unchanged.
    run_country_year_stream(spark, SF001, out, progress)
    assert sorted(os.listdir(os.path.join(progress, "commits"))) == commits
    assert _rows(spark.read.parquet(out)) == first
