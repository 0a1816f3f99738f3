import math
import json

import numpy as np
import pytest

from terrapanel.operators.geo import country_codes, nearest_place
from terrapanel.operators.mapout import (
    code_merge,
    emission_class,
    grid_cells,
    point_features,
    to_geojson,
    write_geojson_lines,
)


def _xyz(lat, lon):
    la, lo = math.radians(lat), math.radians(lon)
    return np.array([math.cos(la) * math.cos(lo), math.cos(la) * math.sin(lo), math.sin(la)])


def _brute(points, places):
    out = {}
    for lat, lon in points:
        v = _xyz(lat, lon)
        best = min((float(np.linalg.norm(v - _xyz(plat, plon))), pid) for pid, plat, plon, _ in places)
        out[(lat, lon)] = best[1]
    return out


@pytest.mark.parametrize("leaf_places", [8, 1, 2000])
def test_nearest_place_matches_brute_force(spark, leaf_places):
    rng = np.random.default_rng(11)
    places = []
    # a dense cluster (a third of the places within ~1 km) plus scattered places
    for i in range(300):
        places.append((i, 48.85 + rng.normal() * 0.01, 2.35 + rng.normal() * 0.01, "FR"))
    for i in range(300, 900):
        places.append((i, float(rng.uniform(-89, 89)), float(rng.uniform(-180, 180)), f"C{i % 7}"))
    points = [(48.85 + float(rng.normal()) * 0.02, 2.35 + float(rng.normal()) * 0.02) for _ in range(50)]
    points += [(float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for _ in range(150)]
    points += [(90.0, 0.0), (-90.0, 0.0), (0.0, 180.0), (0.0, -180.0)]
    pl = spark.createDataFrame(places, "place_id long, latitude double, longitude double, cc string")
    pt = spark.createDataFrame(points, "latitude double, longitude double")
    got = {(r.latitude, r.longitude): r.place_id for r in nearest_place(pt, pl, leaf_places).collect()}
    assert got == _brute(points, places)


def _candidates(spark, places, points):
    """Candidates a point, after the answer was compared with all places."""
    from pyspark.sql import functions as F

    from terrapanel.operators.geo import _distinct_places, _with_xyz, candidate_places

    pl = spark.createDataFrame(places, "place_id long, latitude double, longitude double, cc string")
    pt = spark.createDataFrame(points, "latitude double, longitude double")
    got = {(r.latitude, r.longitude): r.place_id for r in nearest_place(pt, pl).collect()}
    xyz = np.array([_xyz(la, lo) for _, la, lo, _ in places])
    for la, lo in points:
        far = np.linalg.norm(xyz - _xyz(la, lo), axis=1)
        assert np.linalg.norm(xyz[got[(la, lo)]] - _xyz(la, lo)) <= far.min() + 1e-15
    counts = candidate_places(_with_xyz(pt.distinct()), _distinct_places(pl)).groupBy("latitude", "longitude").agg(F.count("*").alias("n"))
    return [r.n for r in counts.collect()]


def test_one_region_and_points_all_over_the_world(spark):
    """Points far from all places, also the ones on the opposite side, meet few of them."""
    rng = np.random.default_rng(3)
    places = [(i, float(rng.uniform(45, 50)), float(rng.uniform(0, 8)), "FR") for i in range(4000)]
    points = [(float(math.degrees(math.asin(rng.uniform(-1, 1)))), float(rng.uniform(-180, 180))) for _ in range(300)]
    points += [(-47.5, -176.0), (-46.0, -173.0), (90.0, 0.0), (-90.0, 0.0)]
    n = _candidates(spark, places, points)
    assert len(n) == len(points) and sum(n) / len(n) <= 50


def test_a_city_with_a_third_of_all_places(spark):
    rng = np.random.default_rng(4)
    places = [(i, 48.85 + float(rng.normal()) * 0.02, 2.35 + float(rng.normal()) * 0.02, "FR") for i in range(3000)]
    places += [(3000 + i, float(rng.uniform(-60, 70)), float(rng.uniform(-180, 180)), "X") for i in range(6000)]
    points = [(48.85 + float(rng.normal()) * 0.03, 2.35 + float(rng.normal()) * 0.03) for _ in range(300)]
    points += [(float(rng.uniform(-90, 90)), float(rng.uniform(-180, 180))) for _ in range(200)]
    n = _candidates(spark, places, points)
    assert len(n) == len(points) and sum(n) / len(n) <= 50


def test_nearest_place_without_places(spark):
    pl = spark.createDataFrame([], "place_id long, latitude double, longitude double, cc string")
    pt = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "latitude double, longitude double")
    assert nearest_place(pt, pl).collect() == []
    assert nearest_place(pt.limit(0), pl).collect() == []


def test_nearest_place_with_a_hot_position(spark):
    # a third of all places share one position: they collapse to the smallest id
    places = [(1000 + i, 10.0, 20.0, "HOT") for i in range(200)]
    places += [(i, -30.0 + i * 0.37, -100.0 + i * 0.91, "C%d" % (i % 5)) for i in range(400)]
    points = [(10.0, 20.0), (10.001, 20.001), (-29.9, -99.0), (45.0, 45.0)]
    pl = spark.createDataFrame(places, "place_id long, latitude double, longitude double, cc string")
    pt = spark.createDataFrame(points, "latitude double, longitude double")
    got = {(r.latitude, r.longitude): r.place_id for r in nearest_place(pt, pl).collect()}
    assert got == _brute(points, places)
    assert got[(10.0, 20.0)] == 1000


def test_unknown_code_is_na(spark):
    near = spark.createDataFrame([(1.0, 2.0, 1, "XX"), (3.0, 4.0, 2, "FR")],
                                 "latitude double, longitude double, place_id long, cc string")
    iso = spark.createDataFrame([("FR", "FRA")], "alpha_2 string, alpha_3 string")
    got = {r.cc: r.country_code for r in country_codes(near, iso).collect()}
    assert got == {"XX": "NA", "FR": "FRA"}


def test_emission_classes(spark):
    df = spark.createDataFrame([(1.99,), (2.0,), (9.99,), (10.0,), (None,), (float("nan"),)], "co2 double")
    assert [r.c for r in df.select(emission_class("co2").alias("c")).collect()] == [
        "green", "orange", "orange", "red", "red", "red"]


def test_point_features_and_geojson(spark, tmpdir_path):
    pts = spark.createDataFrame([(" FRA", "France", 46.0, 2.0), ("DEU ", "Germany", 51.0, 10.0)],
                                "code_3 string, Country string, Latitude double, Longitude double")
    vals = spark.createDataFrame([("FRA", 1.5), ("DEU", 12.25)], "code_3 string, co2 double")
    feats = point_features(code_merge(pts, vals))
    rows = {r.code_3: r for r in feats.collect()}
    assert rows["FRA"].fill_color == "green" and rows["DEU"].fill_color == "red"
    assert rows["DEU"].popup == "Country : Germany<br>\n                    Average co2 emission(kt) : 12.25<br>"
    assert (rows["FRA"].radius, rows["FRA"].color, rows["FRA"].fill_opacity) == (5, "grey", 0.7)
    geo = [json.loads(r.feature) for r in to_geojson(feats).collect()]
    assert {g["geometry"]["coordinates"][0] for g in geo} == {2.0, 10.0}
    out = f"{tmpdir_path}/features"
    write_geojson_lines(feats, out)
    assert spark.read.text(out).count() == 2
    cells = grid_cells(feats, 30.0).collect()
    assert sorted((c.cell_lat, c.cell_lon, c.n_points) for c in cells) == [(1, 0, 2)]


def test_map_inputs_from_csv(spark, tmpdir_path):
    from terrapanel.sources import files

    pts, vals = f"{tmpdir_path}/points.csv", f"{tmpdir_path}/co2.csv"
    with open(pts, "w") as fh:
        fh.write('code_3,Country,Latitude,Longitude\n" FRA",France,46.2,2.2\nDEU ,Germany,51.1,10.4\n')
    with open(vals, "w") as fh:
        fh.write("code_3,co2\nFRA,1.5\nDEU,9.99\nITA,3.0\n")
    p, v = files.read_map_inputs(spark, pts, vals)
    got = {r.code_3: r.fill_color for r in point_features(code_merge(p, v)).collect()}
    assert got == {"FRA": "green", "DEU": "orange"}
