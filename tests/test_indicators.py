import math

import numpy as np
import pytest

from terrapanel.operators.indicators import (
    clean_indicator,
    knn_fill,
    knn_impute,
    min_present,
    to_cells,
    wide_to_long,
)
from terrapanel.sources import files

IDS = ["Country Name", "Country Code", "Indicator Name", "Indicator Code"]


def _wide(spark, rows, years):
    cols = ", ".join([f"`{c}` string" for c in IDS] + [f"`{y}` double" for y in years])
    return spark.createDataFrame(rows, cols)


def test_min_present(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, 2.0)], "k string, x double, y double")
    assert min_present(df, 3).count() == 1
    assert min_present(df, 2).count() == 2


def test_knn_worked_example(spark):
    rows = [("A", "A", "i", "c", 1.0, 2.0, None), ("B", "B", "i", "c", 3.0, 4.0, 3.0),
            ("C", "C", "i", "c", None, 6.0, 5.0), ("D", "D", "i", "c", 8.0, 8.0, 7.0)]
    wide = _wide(spark, rows, ["2000", "2001", "2002"])
    out = {r["Country Code"]: (r["2000"], r["2001"], r["2002"])
           for r in knn_impute(wide, IDS, "Country Code", k=2).collect()}
    assert out == {"A": (1.0, 2.0, 4.0), "B": (3.0, 4.0, 3.0), "C": (5.5, 6.0, 5.0), "D": (8.0, 8.0, 7.0)}


def _brute_knn(mat: np.ndarray, k: int) -> np.ndarray:
    """NaN-aware k-nearest-neighbour fill, written directly from its definition."""
    n, t = mat.shape
    out = mat.copy()
    col_mean = np.nanmean(mat, axis=0)
    for i in range(n):
        for j in range(t):
            if not np.isnan(mat[i, j]):
                continue
            cands = []
            for b in range(n):
                if b == i or np.isnan(mat[b, j]):
                    continue
                shared = ~np.isnan(mat[i]) & ~np.isnan(mat[b])
                if shared.sum() == 0:
                    continue
                d = math.sqrt(t / shared.sum() * np.sum((mat[i, shared] - mat[b, shared]) ** 2))
                cands.append((d, b))
            cands.sort()
            out[i, j] = np.mean([mat[b, j] for _, b in cands[:k]]) if cands else col_mean[j]
    return out


@pytest.mark.parametrize("seed,bucket", [(7, 32), (8, 8), (9, 1), (10, 3)])
def test_knn_matches_brute_force(spark, seed, bucket):
    rng = np.random.default_rng(seed)
    n, t = 30, 8
    mat = rng.normal(size=(n, t)) * 10
    mat[rng.random((n, t)) < 0.2] = np.nan
    mat[3, :] = np.nan          # a row with one value: few shared years with anyone
    mat[3, 0] = 1.0
    mat[5, :] = np.nan          # a row with nothing: every gap gets the year mean
    mat[6, 2:] = mat[7, 2:]     # an exact duplicate on most years (ties on the band edge)
    mat[8] = mat[9] * 1000      # a far outlier
    years = [str(2000 + j) for j in range(t)]
    rows = [(f"n{i:02d}", f"c{i:02d}", "i", "c", *[None if np.isnan(v) else float(v) for v in mat[i]])
            for i in range(n)]
    wide = _wide(spark, rows, years)
    got = {(r["Country Code"], r["_period"]): r["imputed"]
           for r in knn_fill(to_cells(wide, IDS), "Country Code", t, 2, bucket).collect()}
    ref = _brute_knn(mat, 2)
    for i in range(n):
        for j in range(t):
            if np.isnan(mat[i, j]):
                assert got[(f"c{i:02d}", 2000 + j)] == pytest.approx(ref[i, j], rel=1e-9)


def _log_normal(spark, n, t):
    """Entities of very different sizes, steady over the years; some lack single years, some the early ones."""
    from pyspark.sql import functions as F

    def noise(*keys):
        return (F.pmod(F.xxhash64("id", *[F.lit(k) for k in keys]), F.lit(1_000_003)) + 0.5) / 1_000_003.0

    normal = F.sqrt(-2 * F.log(noise(1))) * F.cos(2 * math.pi * noise(2))
    rows = spark.range(n).withColumn("size", F.exp(2 * normal))
    present = [(noise("gap", y) > 0.02) & ((noise("late") > 0.2) | (F.lit(y) >= t // 3)) for y in range(t)]
    value = [F.when(present[y], F.col("size") * (1 + 0.002 * noise("v", y))) for y in range(t)]
    cells = F.explode(F.array(*[F.struct(F.lit(2000 + y).alias("_period"), value[y].alias("_value")) for y in range(t)]))
    return rows.select(F.format_string("e%07d", F.col("id")).alias("code"), cells.alias("c")).select("code", "c.*")


def test_knn_of_heavy_tailed_values_meets_few_donors(spark, monkeypatch):
    from terrapanel.operators import indicators

    n, t = 3000, 9
    cells = _log_normal(spark, n, t).persist()
    met = []

    def counted(*args, search=indicators.candidate_donors):
        found = search(*args)
        met.append(found.count())
        return found

    monkeypatch.setattr(indicators, "candidate_donors", counted)
    got = {(r["code"], r["_period"]): r["imputed"] for r in knn_fill(cells, "code", t, 2).collect()}
    mat = np.full((n, t), np.nan)
    for r in cells.where("_value IS NOT NULL").collect():
        mat[int(r["code"][1:]), r["_period"] - 2000] = r["_value"]
    receivers = np.flatnonzero(np.isnan(mat).any(axis=1))
    assert len(got) == np.isnan(mat).sum() and sum(met) < 0.1 * n * len(receivers)
    for i in receivers[::7]:
        diff = (mat - mat[i]) ** 2
        shared = (~np.isnan(diff)).sum(axis=1)
        d = np.sqrt(np.where(shared, t / np.maximum(shared, 1) * np.nansum(diff, axis=1), np.inf))
        d[i] = np.inf
        for y in np.flatnonzero(np.isnan(mat[i])):
            order = [b for b in np.argsort(d, kind="stable") if not np.isnan(mat[b, y]) and np.isfinite(d[b])][:2]
            assert got[(f"e{i:07d}", 2000 + y)] == pytest.approx(mat[order, y].mean(), rel=1e-9)
    cells.unpersist()


def test_unpivot_skips_gaps(spark):
    rows = [("A", "A", "i", "c", 1.0, None), ("B", "B", "i", "c", None, 4.0)]
    wide = _wide(spark, rows, ["1960", "1961"])
    long = wide_to_long(wide.drop("Indicator Name", "Indicator Code"), ["Country Name", "Country Code"], "v")
    assert sorted(tuple(r) for r in long.collect()) == [("A", "A", 1960, 1.0), ("B", "B", 1961, 4.0)]


def test_clean_indicator_end_to_end(spark):
    rows = [("A", "A", "i", "c", 1.0, 2.0, None), ("B", "B", "i", "c", 3.0, 4.0, 3.0),
            ("C", "C", "i", "c", None, 6.0, 5.0), ("D", "D", "i", "c", 8.0, 8.0, 7.0),
            ("E", "E", "i", "c", None, None, 1.0)]
    wide = _wide(spark, rows, ["2000", "2001", "2002"])
    out = clean_indicator(wide, IDS, "Country Code", "CO2_emission", 6, 2,
                          drop=["Indicator Name", "Indicator Code"])
    got = sorted(tuple(r) for r in out.collect())
    assert len(got) == 12 and ("A", "A", 2002, 4.0) in got and ("C", "C", 2000, 5.5) in got
    assert all(r[1] != "E" for r in got)


def test_quoted_name_csv(spark, tmpdir_path):
    path = f"{tmpdir_path}/co2.csv"
    with open(path, "w") as fh:
        fh.write('Country Name,Country Code,Year,CO2_emission\n"Bahamas, The",BHS,1960,1.5\n')
    row = files.read_indicator_long(spark, path, "CO2_emission").collect()[0]
    assert (row.country_code, row.year, row.co2_emission) == ("BHS", 1960, 1.5)


def test_wide_csv_round_trip(spark, tmpdir_path):
    path = f"{tmpdir_path}/wide.csv"
    with open(path, "w") as fh:
        fh.write("Country Name,Country Code,Indicator Name,Indicator Code,1960,1961\n")
        fh.write('"Bahamas, The",BHS,CO2,EN.ATM,1.5,\n')
        fh.write("Aruba,ABW,CO2,EN.ATM,x,2.0\n")
    wide = files.read_indicator_wide(spark, path)
    assert wide.columns == IDS + ["1960", "1961"]
    rows = {r["Country Code"]: (r["1960"], r["1961"]) for r in wide.collect()}
    assert rows == {"BHS": (1.5, None), "ABW": (None, 2.0)}
    out = f"{tmpdir_path}/long"
    files.write_csv(wide_to_long(wide.drop("Indicator Name", "Indicator Code"),
                                 ["Country Name", "Country Code"], "CO2_emission"), out)
    back = files.read_indicator_long(spark, out, "CO2_emission")
    assert sorted(tuple(r) for r in back.collect()) == [("ABW", 1961, 2.0), ("BHS", 1960, 1.5)]
