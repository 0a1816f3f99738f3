import datetime as dt
import os

import pytest

from terrapanel.operators.clean import clean_observations
from terrapanel.operators.panel import country_year
from pyspark.sql import functions as F

from terrapanel.sources import files

HEADER = ",".join(f'"{c}"' for c in files.GSOD_COLUMNS)


def _line(station, date, lat, lon, temp, prcp, flag, sndp):
    vals = {c: "" for c in files.GSOD_COLUMNS}
    vals.update({"STATION": station, "DATE": date, "LATITUDE": lat, "LONGITUDE": lon, "ELEVATION": "10.0",
                 "NAME": "SOME PLACE, XX", "TEMP": temp, "TEMP_ATTRIBUTES": " 24", "PRCP": prcp,
                 "PRCP_ATTRIBUTES": flag, "SNDP": sndp, "FRSHTT": "000000"})
    return ",".join(f'"{vals[c]}"' for c in files.GSOD_COLUMNS)


def _write(root, year, station, lines):
    d = os.path.join(root, str(year))
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, f"{station}.csv"), "w") as fh:
        fh.write(HEADER + "\n" + "\n".join(lines) + "\n")


def test_read_station_day_files(spark, tmpdir_path):
    _write(tmpdir_path, 1960, "01", [
        _line("01", "1960-01-01", "70.93", "-8.66", "  30.5", " 0.50", "A", " 999.9"),
        _line("01", "1960-01-02", "70.93", "-8.66", "  31.5", "99.9", "D", "   3.1"),
    ])
    _write(tmpdir_path, 1961, "02", [
        _line("02", "1961-07-01", "", "", "  50.0", " 0.20", " ", " 999.9"),
        _line("02", "1961-07-02", "12.5", "3.25", "  52.0", " 0.20", "", " 999.9"),
    ])
    obs = files.read_observations(spark, f"{tmpdir_path}/*/*.csv")
    rows = {(r.station, r.obs_date): r for r in obs.collect()}
    assert len(rows) == 4                       # one header per file skipped
    r = rows[("01", dt.date(1960, 1, 1))]
    assert (r.latitude, r.longitude, r.temp, r.prcp, r.prcp_flag, r.snow_depth) == (
        70.93, -8.66, 30.5, 0.5, "A", 999.9)
    blank = rows[("02", dt.date(1961, 7, 1))]
    assert blank.latitude is None and blank.longitude is None
    clean = {(r.station, r.obs_date): (r.precipitation, r.snow) for r in clean_observations(obs).collect()}
    assert clean[("01", dt.date(1960, 1, 1))] == (3.0, 0.0)
    assert clean[("01", dt.date(1960, 1, 2))] == (0.0, 3.1)
    assert clean[("02", dt.date(1961, 7, 1))] == pytest.approx((0.2, 0.0))
    assert clean[("02", dt.date(1961, 7, 2))] == pytest.approx((0.2, 0.0))
    yearly = clean_observations(obs, require_coordinates=True).withColumn("country_code", obs.station)
    got = {(r.country_code, r.year): r.n_obs for r in country_year(yearly).collect()}
    assert got == {("01", 1960): 2, ("02", 1961): 1}


def test_parquet_round_trip_partitioned(spark, tmpdir_path):
    df = spark.createDataFrame([("A", 1960, 1.0), ("A", 1961, 2.0), ("B", 1960, 3.0)],
                               "country_code string, year int, v double")
    out = f"{tmpdir_path}/long"
    files.write_parquet(df, out, partition_by=["year"])
    back = spark.read.parquet(out)
    assert sorted((r.country_code, r.year, r.v) for r in back.collect()) == [
        ("A", 1960, 1.0), ("A", 1961, 2.0), ("B", 1960, 3.0)]
    assert back.where("year = 1961").count() == 1


def test_malformed_records_are_rejected_with_a_reason(spark, tmpdir_path):
    good = _line("01", "1960-01-01", "70.93", "-8.66", "  30.5", " 0.50", "A", " 999.9")
    blanks = _line("01", "1960-01-02", "", "", "  ", "", "", "")
    short = good.rsplit(",", 1)[0]
    bad = {
        "fields": [short, good + ',"x"', '"01"'],
        "date": [_line("01", d, "1", "1", "1", "0", "A", "0") for d in ("1961-02-29", "", "01/02/1960")],
        "station": [_line("  ", "1960-01-01", "1", "1", "1", "0", "A", "0")],
        "number: TEMP": [_line("01", "1960-01-01", "1", "1", "n/a", "0", "A", "0")],
        "number: SNDP": [_line("01", "1960-01-01", "1", "1", "1", "0", "A", "x 1")],
    }
    _write(tmpdir_path, 1960, "01", [good, *bad["fields"], blanks])
    _write(tmpdir_path, 1961, "02", [line for k, lines in bad.items() if k != "fields" for line in lines])
    path = f"{tmpdir_path}/*/*.csv"
    kept = {r.obs_date: r for r in files.read_observations(spark, path).collect()}
    assert set(kept) == {dt.date(1960, 1, 1), dt.date(1960, 1, 2)}
    assert kept[dt.date(1960, 1, 2)].temp is None and kept[dt.date(1960, 1, 2)].latitude is None
    rejects = files.read_observation_rejects(spark, path).collect()
    assert sorted(r.reason for r in rejects) == sorted(k for k, lines in bad.items() for _ in lines)
    assert sorted(r.record for r in rejects if r.reason == "fields") == sorted(bad["fields"])
    # No group of a null year comes out of a bad date.
    obs = files.read_observations(spark, path)
    clean = clean_observations(obs, require_coordinates=True).withColumn("country_code", obs.station)
    assert [(r.country_code, r.year) for r in country_year(clean).collect()] == [("01", 1960)]
    # Good and bad records together are all records, in any projection.
    assert obs.count() + len(rejects) == files.read_observation_records(spark, path).count() == 11


def test_written_station_day_files_keep_padding_and_headers(spark, tmpdir_path):
    fields = spark.createDataFrame([(1960, '  1.5', 'A "B", C'), (1961, " ", "")], "year int, TEMP string, NAME string")
    files.write_station_day_files(fields.coalesce(1), f"{tmpdir_path}/out")
    found = {}
    for year in (1960, 1961):
        folder = os.path.join(tmpdir_path, "out", f"year={year}")
        (name,) = [f for f in os.listdir(folder) if f.endswith(".csv")]
        with open(os.path.join(folder, name)) as fh:
            found[year] = fh.read().splitlines()
    assert found == {1960: ['"TEMP","NAME"', '"  1.5","A ""B"", C"'], 1961: ['"TEMP","NAME"', '" ",""']}


def _reading_tables(spark, folder):
    """400 readings of 5 stations, two of them unknown, over two years."""
    from datetime import datetime, timedelta

    lines = [(i, 1 + i % 3, i % 7, (i % 5) + 1, 10.0, 100.0, 0.01, 0.02, "N", "O", datetime(1995, 1, 1) + timedelta(days=(i * 37) % 700))
             for i in range(400)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double,"
                          " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(i, f"S{i}", 1, 0.0) for i in (1, 2, 3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(1, "AA", 1)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    return {(10 * line[0] + line[1]): line for line in lines}


def test_station_day_fields_come_ordered_by_year_while_narrow(spark, tmpdir_path):
    """The write by year adds no sort of the wide fields: their plan is ordered by year already, and the sort holds no text field."""
    from terrapanel.sources import tables

    _reading_tables(spark, tmpdir_path)
    fields = tables.station_day_file_fields(spark, tmpdir_path, 3)
    plan = fields._jdf.queryExecution().optimizedPlan()
    assert "year" in plan.outputOrdering().toString()
    assert "FRSHTT" not in plan.toString().split("Sort [year", 1)[1]
    assert sorted(map(str, fields.collect())) == sorted(map(str, tables.station_day_file_fields(spark, tmpdir_path).collect()))


def test_raw_files_are_gzipped_and_whole(spark, tmpdir_path):
    from terrapanel.plans.common import station_day_files

    keys = _reading_tables(spark, tmpdir_path)
    raw = station_day_files(spark, tmpdir_path)
    assert raw.endswith(".csv.gz")
    bad = [k for k in keys if 1 <= k % 97 <= 5]
    assert files.read_observation_rejects(spark, raw).count() == len(bad) > 5
    obs = files.read_observations(spark, raw, "file")
    assert obs.count() == len(keys) - len(bad)
    # A station's month is in one file, so sums by file are no more than sums by station.
    month = F.date_format("obs_date", "yyyy-MM")
    assert obs.groupBy("station", month).agg(F.count_distinct("file").alias("n")).where("n > 1").isEmpty()
