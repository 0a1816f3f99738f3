"""Property tests."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrapanel.functions.stats import with_t_tail
from terrapanel.operators.panel import build_panel
from terrapanel.operators.regress import group_betas
from terrapanel.operators.sarima import Order, difference_poly, forecast
from terrapanel.operators.stats import zscore_by

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.floats(min_value=-1e3, max_value=1e3, allow_nan=False), min_size=3, max_size=30)


@FEW
@given(values)
def test_zscores_have_mean_zero_and_unit_sd(spark, xs):
    if np.std(xs) < 1e-6:
        return
    df = spark.createDataFrame([("g", float(x)) for x in xs], "g string, x double")
    z = np.array([r.z_x for r in zscore_by(df, ["x"], ["g"]).collect()])
    assert abs(z.mean()) < 1e-9 and abs(z.std() - 1) < 1e-9


@FEW
@given(st.permutations(list(range(12))))
def test_panel_join_ignores_input_order(spark, perm):
    base = [("c%d" % (i % 3), 2000 + i // 3, float(i), float(i * 2)) for i in range(12)]
    ind = [("c%d" % (i % 3), 2000 + i // 3, float(i) / 7) for i in range(12)]
    a = spark.createDataFrame([base[i] for i in perm], "country_code string, year int, t double, p double")
    b = spark.createDataFrame([ind[i] for i in reversed(perm)], "country_code string, year int, co2 double")
    got = sorted(tuple(r) for r in build_panel(a, b).collect())
    ref = sorted((c, y, t, p, v) for (c, y, t, p), (_, _, v) in zip(base, ind))
    assert got == ref


@FEW
@given(st.floats(min_value=0.01, max_value=1e4), st.integers(min_value=0, max_value=10_000))
def test_betas_are_scale_free(spark, scale, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for g in ("a", "b"):
        for i in range(12):
            x = rng.normal(size=4)
            rows.append((g, i, float(x @ [0.5, -0.2, 0.1, 0.3] + rng.normal()), *map(float, x)))
    cols = "country_code string, year int, temperature double, co2 double, precipitation double, energy double, population double"
    df = spark.createDataFrame(rows, cols)
    scaled = df.withColumn("co2", F.col("co2") * scale + 7.0)
    one = {r.country_code: r for r in group_betas(df).collect()}
    two = {r.country_code: r for r in group_betas(scaled).collect()}
    for g in one:
        assert one[g].co2 == pytest.approx(two[g].co2, rel=1e-6, abs=1e-9)
        assert one[g].energy == pytest.approx(two[g].energy, rel=1e-6, abs=1e-9)


def test_t_tail_monotone_and_limits(spark):
    ts = [0.0, 0.5, 1.0, 2.0, 4.0, 8.0, -2.0]
    df = spark.createDataFrame([(t, 12) for t in ts], "t double, dof long")
    p = {r.t: r.p for r in with_t_tail(df, "t", "dof", "p").collect()}
    assert p[0.0] == pytest.approx(0.5)
    assert p[0.5] > p[1.0] > p[2.0] > p[4.0] > p[8.0] > 0
    assert p[-2.0] == pytest.approx(p[2.0])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(min_value=-100, max_value=100, allow_nan=False), min_size=30, max_size=60),
       st.integers(min_value=0, max_value=2), st.integers(min_value=0, max_value=1))
def test_differencing_is_inverted_by_the_recursion(ys, d, big_d):
    """With all model coefficients zero, forecasting extends the series so that
    its (1-B)^d (1-B^12)^D difference stays zero: the recursion undoes the differencing."""
    order = Order(0, d, 0, 0, big_d, 0, 12)
    y = np.array(ys)
    if len(y) <= d + 12 * big_d:
        return
    ext = np.concatenate([y, forecast(y, np.zeros(0), order, 12)])
    delta = difference_poly(order)
    w = np.convolve(ext, delta)[len(delta) - 1:len(ext)]
    assert np.allclose(w[len(y) - (len(delta) - 1):], 0.0, atol=1e-6)


coords = st.tuples(st.floats(min_value=-90, max_value=90, allow_nan=False),
                   st.floats(min_value=-180, max_value=180, allow_nan=False))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(coords, min_size=1, max_size=40), st.lists(coords, min_size=1, max_size=15),
       st.sampled_from([1, 3, 8]))
def test_nearest_place_equals_brute_force(spark, places, points, leaf_places):
    from terrapanel.operators.geo import nearest_place
    from tests.test_geo_map import _brute

    rows = [(i, float(la), float(lo), "X") for i, (la, lo) in enumerate(places)]
    rows += [(1000 + i, float(la), float(lo), "Y") for i, (la, lo) in enumerate(places[:3])]  # duplicates
    pts = sorted({(float(la), float(lo)) for la, lo in points} | {(90.0, 0.0), (0.0, -180.0)})
    pl = spark.createDataFrame(rows, "place_id long, latitude double, longitude double, cc string")
    pt = spark.createDataFrame(pts, "latitude double, longitude double")
    got = {(r.latitude, r.longitude): r.place_id for r in nearest_place(pt, pl, leaf_places).collect()}
    assert got == _brute(pts, rows)


def test_scale_settings_bounds():
    from terrapanel.session import scale_settings

    small, big = scale_settings(10 * 1024 ** 3), scale_settings(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "102400"  # 1 GB a reducer
    few = scale_settings(100 * 1024 ** 4, max_shuffle_partitions=5000)
    assert few["spark.sql.shuffle.partitions"] == few["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "5000"
