"""Versions, the stored roll-up and the bucketed layout."""

import os
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from terrapanel.operators import rollup_store
from terrapanel.operators.clean import clean_observations
from terrapanel.operators.panel import month_series
from terrapanel.sources import files, layout, versions


def _station_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as out:
        out.write(",".join(f'"{c}"' for c in files.GSOD_COLUMNS) + "\n")
        for station, date, lat, temp in rows:
            field = {"STATION": station, "DATE": date, "LATITUDE": lat, "LONGITUDE": lat, "TEMP": f" {temp}",
                     "PRCP": " 0.10", "PRCP_ATTRIBUTES": "G", "SNDP": "999.9"}
            out.write(",".join(f'"{field.get(c, "")}"' for c in files.GSOD_COLUMNS) + "\n")


def _years(spark, folder):
    st = spark.createDataFrame([("1", "AA"), ("2", "BB")], "station string, country_code string")
    return {(r.country_code, r.year): (r.temperature, r.n_obs)
            for r in rollup_store.country_years(rollup_store.sums_of(spark, folder), st).collect()}


def test_update_reads_new_and_changed_files_only(spark, tmpdir_path):
    data, root = f"{tmpdir_path}/days", f"{tmpdir_path}/store"
    _station_file(f"{data}/1990", "one", [("1", "1990-01-01", "5", 10), ("1", "1990-01-02", "5", 20)])
    _station_file(f"{data}/1990", "two", [("2", "1990-02-01", "", 50), ("2", "1990-02-02", "7", 60)])
    first = rollup_store.update(spark, root, f"{data}/*/*.csv")
    assert len(first.read) == 2
    assert _years(spark, first.folder) == {("AA", 1990): (15.0, 2), ("BB", 1990): (60.0, 1)}
    again = rollup_store.update(spark, root, f"{data}/*/*.csv")
    assert again == rollup_store.Update(first.folder, ())

    _station_file(f"{data}/1991", "one", [("1", "1991-01-01", "5", 30), ("x", "1991-13-01", "5", 30)])
    second = rollup_store.update(spark, root, f"{data}/*/*.csv")
    assert [os.path.basename(os.path.dirname(f)) for f in second.read] == ["1991"]
    _station_file(f"{data}/1990", "one", [("1", "1990-01-01", "5", 10), ("1", "1990-01-02", "5", 20), ("1", "1990-03-02", "5", 60)])
    third = rollup_store.update(spark, root, f"{data}/*/*.csv")
    assert [os.path.basename(f) for f in third.read] == ["one.csv"]
    assert _years(spark, third.folder) == {("AA", 1990): (30.0, 3), ("BB", 1990): (60.0, 1), ("AA", 1991): (30.0, 1)}
    # A file that is no longer asked for takes its readings with it, without any reading.
    fourth = rollup_store.update(spark, root, f"{data}/1990/*.csv")
    assert fourth.read == () and set(_years(spark, fourth.folder)) == {("AA", 1990), ("BB", 1990)}

    sums = rollup_store.sums_of(spark, third.folder)
    want = month_series(clean_observations(files.read_observations(spark, f"{data}/*/*.csv")))
    columns = ["year", "month", "temperature", "precipitation", "n_obs"]
    assert sorted(rollup_store.months(sums).select(columns).collect()) == sorted(want.select(columns).collect())
    for series in (rollup_store.months(sums), sums.groupBy("year").count()):
        plan = series._jdf.queryExecution().executedPlan().toString()
        assert "csv" not in plan.lower()


def test_no_files_is_an_error(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/none")
    with pytest.raises(ValueError):
        rollup_store.update(spark, f"{tmpdir_path}/store", f"{tmpdir_path}/none")


def test_published_follows_its_input_and_survives_a_crash(spark, tmpdir_path):
    data, root = f"{tmpdir_path}/in", f"{tmpdir_path}/versions"
    spark.range(3).write.parquet(data)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(data).agg(F.count(F.lit(1)).alias("n"))

    assert versions.published(spark, root, data, "counts", build).first()["n"] == 3
    assert versions.published(spark, root, data, "counts", build).first()["n"] == 3
    assert len(built) == 1
    old = versions.latest(spark, f"{root}/counts")
    spark.range(4).write.mode("append").parquet(data)

    def crash():
        return spark.read.parquet(data).select(F.raise_error(F.lit("lost")).alias("n"))

    with pytest.raises(Exception, match="lost"):
        versions.published(spark, root, data, "counts", crash)
    assert versions.latest(spark, f"{root}/counts") == old
    assert spark.read.parquet(f"{old}/counts").first()["n"] == 3
    assert versions.published(spark, root, data, "counts", build).first()["n"] == 7
    new = versions.latest(spark, f"{root}/counts")
    gone = versions.clean_up(spark, f"{root}/counts", [new])
    assert len(gone) == 2 and old in gone
    assert versions.published(spark, root, data, "counts", build).first()["n"] == 7 and len(built) == 2


def test_layout_prunes_years_and_joins_without_exchange(spark, tmpdir_path):
    name = f"layout_{uuid4().hex[:8]}"
    days = [(s, y, m, float((s or 0) + m)) for s in (1, 2, 3, None) for y in (1990, 1991, None) for m in range(1, 13)]
    # One station has most of the readings.
    readings = spark.createDataFrame(days + [(1, 1990, m, 0.0) for m in range(1, 13)] * 50, "station long, year int, month int, temperature double")
    stations = spark.createDataFrame([(1, "AA"), (2, "BB"), (9, "CC")], "station long, country_code string")
    layout.write_layout(readings, stations, name, f"{tmpdir_path}/{name}", 8)
    want = sorted(tuple(r) for r in readings.join(stations, "station").select("station", "year", "month", "temperature", "country_code").collect()
                  if r.year is not None)
    got = layout.located_readings(spark, name).where("year IS NOT NULL").select("station", "year", "month", "temperature", "country_code")
    assert sorted(tuple(r) for r in got.collect()) == want
    assert layout.located_readings(spark, name).count() == readings.join(stations, "station").count()

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one_year = layout.located_readings(spark, name, 1991, 1991)
        plan = one_year._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert one_year.count() == 24
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # The busy station's readings are in several buckets.
    busy = spark.table(f"{name}_readings").where("station = 1").select(F.input_file_name().alias("f")).distinct()
    assert busy.where("f LIKE '%year=1990%'").count() > 3


def test_bucket_count_follows_the_bytes(spark, tmpdir_path):
    spark.range(1000).write.parquet(f"{tmpdir_path}/t")
    listing = versions.input_files(spark, f"{tmpdir_path}/t")
    assert layout.bucket_count(listing, 7) == 8
    assert layout.bucket_count(listing, 1, bucket_bytes=100) > 8


def test_shared_intermediates_follow_their_input(spark, tmpdir_path):
    from terrapanel.plans.common import shared

    spark.range(3).write.parquet(f"{tmpdir_path}/t.parquet")
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(f"{tmpdir_path}/t.parquet")

    assert shared(spark, tmpdir_path, "t", build).count() == 3
    assert shared(spark, tmpdir_path, "t", build).count() == 3 and len(calls) == 1
    spark.range(2).write.mode("append").parquet(f"{tmpdir_path}/t.parquet")
    assert shared(spark, tmpdir_path, "t", build).count() == 5 and len(calls) == 2
