"""Positions and lags by ranges, marker pyramid and minimum-norm betas against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapanel.functions.stats import apply_stages, min_norm_stages
from terrapanel.operators import long_series
from terrapanel.operators.mapout import cell_pyramid
from terrapanel.operators.regress import group_betas


def test_positions_and_lags_equal_brute_force(spark):
    rows = [("long", (i * 7919) % 20011, float(i)) for i in range(20011)]
    rows += [(None, i, float(i)) for i in range(50)] + [("one", 5, 1.0), ("void", 3, None)]
    df = spark.createDataFrame(rows, "s string, t long, v double").repartition(7)
    numbered = long_series.number_rows(df, ["s"], ["t"])
    out = long_series.lags(long_series.split_by_share(numbered, ["s"], 80), ["s"], "v", (1, 13), block=100).collect()
    series = {}
    for s, t, v in rows:
        series.setdefault(s, []).append((t, v))
    want = set()
    for s, points in series.items():
        points.sort(key=lambda p: p[0])
        for i, (t, v) in enumerate(points):
            back = [points[i - k][1] if i >= k else None for k in (1, 13)]
            want.add((s, t, v, i, "train" if i < len(points) * 80 // 100 else "test", *back))
    assert len(out) == len(rows) and {tuple(r) for r in out} == want


def test_one_long_series_is_many_tasks(spark):
    """10 million rows of one series: the ranges are even and every block is bounded."""
    n = 10_000_000
    df = spark.range(n).select(F.lit(1).alias("s"), (F.col("id") * 7919 % n).alias("t"), F.col("id").cast("double").alias("v"))
    numbered = long_series.number_rows(df, ["s"], ["t"])
    assert numbered.where("position <> t").isEmpty()
    lagged = long_series.lags(numbered, ["s"], "v", (12,))
    before = F.col("lag_12") * 7919 % n
    assert lagged.where((F.col("t") >= 12) & (before != F.col("t") - 12)).isEmpty()
    assert lagged.where((F.col("t") >= 12) & F.col("lag_12").isNull()).isEmpty()
    assert lagged.where((F.col("t") < 12) & F.col("lag_12").isNotNull()).isEmpty()
    home = lagged.groupBy(F.floor(F.col("position") / long_series.BLOCK).alias("b")).count()
    assert home.count() == n // long_series.BLOCK


def test_lags_leave_gaps_null_and_check_their_reach(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 4.0)], "s string, month long, v double")
    got = {r.month: r.lag_1 for r in long_series.lags(df, ["s"], "v", (1,), position="month", block=2).collect()}
    assert got == {1: None, 2: 1.0, 4: None}
    with pytest.raises(ValueError):
        long_series.lags(df, ["s"], "v", (5,), position="month", block=2)
    empty = long_series.number_rows(df.where("false"), ["s"], ["month"])
    assert empty.count() == 0


def test_pyramid_levels_hold_the_same_points(spark):
    rng = np.random.default_rng(3)
    points = [(float(a), float(b)) for a, b in zip(rng.uniform(-90, 90, 500), rng.uniform(-180, 180, 500))]
    points += [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)] + [(52.5, 13.4)] * 300
    off = [(None, 1.0), (1.0, None), (float("nan"), 0.0), (91.0, 0.0)]
    got = cell_pyramid(spark.createDataFrame(points + off, "latitude double, longitude double"), zoom=5).collect()
    want = {}
    for z in range(6):
        for lat, lon in points:
            key = (z, min(int((lon + 180) / 360 * 2**z), 2**z - 1), min(int((lat + 90) / 180 * 2**z), 2**z - 1))
            want.setdefault(key, []).append((lat, lon))
    assert {(r.zoom, r.cell_x, r.cell_y): r.n_points for r in got} == {k: len(v) for k, v in want.items()}
    for r in got:
        assert np.allclose((r.centroid_lat, r.centroid_lon), np.mean(want[r.zoom, r.cell_x, r.cell_y], axis=0))
    assert cell_pyramid(spark.createDataFrame(off, "latitude double, longitude double")).count() == 0


@pytest.mark.parametrize("rank", [1, 2, 3, 4])
def test_min_norm_stages_equal_a_pseudo_inverse(spark, rank):
    rng = np.random.default_rng(rank)
    rows, want = [], []
    for _ in range(20):
        half = rng.normal(size=(4, rank))
        a = half @ half.T
        b = a @ rng.normal(size=4)
        rows.append([*map(float, a.ravel()), *map(float, b)])
        want.append(np.linalg.pinv(a, rcond=1e-9, hermitian=True) @ b)
    names = [f"a{i}" for i in range(16)] + [f"b{i}" for i in range(4)]
    stages, x = min_norm_stages([[f"a{4 * i + j}" for j in range(4)] for i in range(4)], [f"b{i}" for i in range(4)], "_t_")
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    got = np.array([[r[c] for c in x] for r in apply_stages(df, stages).collect()])
    assert np.allclose(got, want, rtol=1e-4, atol=1e-5)


def test_min_norm_betas_equal_pinv_betas(spark):
    rng = np.random.default_rng(5)
    cols = ["temperature", "co2", "precipitation", "energy", "population"]
    rows = []
    for g, n in (("few", 3), ("two", 2), ("many", 40), ("twin", 12), ("flat", 12), ("one", 1)):
        for _ in range(n):
            t, a, b, c, d = map(float, rng.normal(size=5))
            rows.append((g, t, a, b, 2 * a if g == "twin" else c, 1.0 if g == "flat" else d))
    df = spark.createDataFrame(rows, "country_code string, " + ", ".join(f"{c} double" for c in cols))
    native = {r.country_code: r for r in group_betas(df, rank_deficient="min_norm").collect()}
    other = {r.country_code: r for r in group_betas(df, rank_deficient="pinv").collect()}
    assert set(native) == set(other) == {r[0] for r in rows}
    for g in ("few", "two", "many", "twin"):
        assert np.allclose(native[g][1:], other[g][1:], atol=1e-6)
    for g in ("flat", "one"):
        assert all(v is None for v in native[g][1:]) and all(v is None for v in other[g][1:])


def test_split_reads_a_long_series_in_many_tasks(spark):
    """One series of 40,000 rows: no task of the split reads more than a few blocks of it."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {c: spark.conf.get(c) for c in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    try:
        df = spark.range(40_000).select(F.lit(1).alias("s"), F.col("id").alias(long_series.POSITION))
        split = long_series.split_by_share(df, ["s"], 80)
        rows = long_series.split_by_share(df, ["s"], 80, block=1000).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(rows) > 3 and max(r["count"] for r in rows) <= 20_000
        assert {(r.split, r["count"]) for r in split.groupBy("split").count().collect()} == {("train", 32_000), ("test", 8_000)}
    finally:
        for c in names:
            spark.conf.set(c, before[c])
