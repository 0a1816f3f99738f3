import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapanel.functions.stats import with_t_tail
from terrapanel.operators.regress import (
    finish_tests,
    group_betas,
    fit_pooled,
    pooled_effects,
    pooled_predictions,
    ridge_fit,
    ridge_tests,
)
from terrapanel.operators.stats import zscore_by, zscore_global
from tests.conftest import SF01


def test_zscore_ddof0(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0)], "g string, x double")
    got = sorted(r.z_x for r in zscore_global(df, ["x"]).collect())
    assert got == pytest.approx([-1.224745, 0.0, 1.224745], abs=1e-6)
    got = sorted(r.z_x for r in zscore_by(df, ["x"], ["g"]).collect())
    assert got == pytest.approx([-1.224745, 0.0, 1.224745], abs=1e-6)


@pytest.mark.parametrize("t,dof,p", [(2.228138852, 10, 0.025), (3.0, 1, 0.1024163823),
                                     (0.0, 5, 0.5), (1.0, 2, 0.2113248654)])
def test_t_tail(spark, t, dof, p):
    df = spark.createDataFrame([(t, dof)], "t double, dof long")
    got = with_t_tail(df, "t", "dof", "p").first().p
    assert got == pytest.approx(p, rel=1e-6)


def test_t_tail_matches_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(3)
    x = rng.normal(size=58)
    y = 0.3 * x + rng.normal(size=58)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    model = LinearRegression(featuresCol="f", labelCol="y", solver="normal", regParam=0.0).fit(
        VectorAssembler(inputCols=["x"], outputCol="f").transform(df))
    t, p_mllib = model.summary.tValues[0], model.summary.pValues[0]
    tail = with_t_tail(spark.createDataFrame([(float(t), 56)], "t double, dof long"), "t", "dof", "p")
    assert 2 * tail.first().p == pytest.approx(p_mllib, rel=1e-6)


def test_decision_tail(spark):
    rows = [("x", "f", 1.0, 1.0, 10)]
    df = spark.createDataFrame(rows, "target string, factor string, beta double, se double, dof long")
    one = finish_tests(df.withColumn("beta", F.lit(1.9)), 0.05, "one").first()
    two = finish_tests(df.withColumn("beta", F.lit(1.9)), 0.05, "two").first()
    assert one.p_one_sided < 0.05 < two.p_two_sided
    assert (one.decision, two.decision) == ("reject", "accept")


def _panel(spark):
    from terrapanel.plans.common import build_country_panel
    return build_country_panel(spark, SF01)


def test_group_betas_match_lstsq(spark):
    pdf = _panel(spark).toPandas()
    got = {r.country_code: r for r in group_betas(_panel(spark)).collect()}
    cols = ["co2", "precipitation", "energy", "population"]
    for cc, g in pdf.groupby("country_code"):
        z = (g[["temperature"] + cols] - g[["temperature"] + cols].mean()) / g[["temperature"] + cols].std(ddof=0)
        x = np.c_[np.ones(len(z)), z[cols].to_numpy()]
        beta = np.linalg.lstsq(x, z["temperature"].to_numpy(), rcond=None)[0]
        row = got[cc]
        assert [row.intercept, row.co2, row.precipitation, row.energy, row.population] == pytest.approx(
            list(beta), abs=1e-7)


def test_group_betas_of_dependent_factors_by_pseudo_inverse(spark):
    """Four rows and four factors: the least-squares solution of least length; other groups and constants as before."""
    rng = np.random.default_rng(7)
    names = ["temperature", "co2", "precipitation", "energy", "population"]
    groups = {"A": rng.normal(size=(4, 5)), "B": rng.normal(size=(12, 5)), "C": rng.normal(size=(12, 5)), "D": rng.normal(size=(12, 5))}
    groups["C"][:, 3] = 2 * groups["C"][:, 1] - 5  # energy repeats co2
    groups["D"][:, 3] = 1.0
    rows = [(g, *map(float, r)) for g, m in groups.items() for r in m]
    df = spark.createDataFrame(rows, "country_code string, " + ", ".join(f"{n} double" for n in names))
    got = {r.country_code: r for r in group_betas(df, rank_deficient="pinv").collect()}
    for g in "ABC":
        z = (groups[g] - groups[g].mean(axis=0)) / groups[g].std(axis=0)
        assert [got[g][n] for n in names[1:]] == pytest.approx(list(np.linalg.pinv(z[:, 1:], rcond=1e-6) @ z[:, 0]), abs=1e-6)
        assert got[g].intercept == 0.0
    assert got["D"].co2 is None and got["D"].intercept is None
    assert [r for r in group_betas(df).collect() if r.country_code == "A"][0].population is None


def _dense_build(pdf, lam=1.0):
    """The pooled statistic built densely: drop-first dummies, ddof-0 z-scores, ridge with bias."""
    import pandas as pd

    dummies = pd.get_dummies(pdf[["country_code", "year"]].astype(str), prefix=["CC", "YEAR"],
                             drop_first=True).astype(float)
    feats = pd.concat([dummies, pdf[["co2", "energy", "population"]]], axis=1)
    z = ((feats - feats.mean()) / feats.std(ddof=0)).to_numpy()
    x = np.c_[np.ones(len(z)), z]
    out = {}
    for target in ["temperature", "precipitation"]:
        y = ((pdf[target] - pdf[target].mean()) / pdf[target].std(ddof=0)).to_numpy()
        beta = np.linalg.solve(x.T @ x + lam * np.eye(x.shape[1]), x.T @ y)
        rss = float(np.sum((x @ beta - y) ** 2))
        dof = len(y) - 8
        var = float(np.sum((x - x.mean()) ** 2))
        se = np.sqrt(rss / dof / var)
        out[target] = (beta, se, list(dummies.columns) + ["co2", "energy", "population"])
        out["pred_" + target] = (x @ beta, (x @ beta - y) ** 2)
    return out


def test_pooled_effects_match_dense(spark):
    pdf = _panel(spark).toPandas()
    ref = _dense_build(pdf)
    coef, tests = pooled_effects(_panel(spark))
    coef = {(r.target, r.term): r.beta for r in coef.collect()}
    for target in ["temperature", "precipitation"]:
        beta, se, names = ref[target]
        assert coef[(target, "intercept")] == pytest.approx(beta[0], abs=1e-9)
        for name, b in zip(names, beta[1:]):
            assert coef[(target, name)] == pytest.approx(b, abs=1e-8)
    for r in tests.collect():
        beta, se, names = ref[r.target]
        assert r.se == pytest.approx(se, rel=1e-8)
        assert r.t == pytest.approx(beta[1 + names.index(r.factor)] / se, rel=1e-6)


def test_three_factor_ridge_matches_dense(spark):
    pdf = _panel(spark).toPandas()
    feats = pdf[["co2", "energy", "population"]]
    z = ((feats - feats.mean()) / feats.std(ddof=0)).to_numpy()
    x = np.c_[np.ones(len(z)), z]
    coef = {(r.target, r.term): r.beta for r in ridge_fit(_panel(spark)).collect()}
    tests = {(r.target, r.factor): r for r in ridge_tests(_panel(spark)).collect()}
    for target in ["temperature", "precipitation"]:
        y = ((pdf[target] - pdf[target].mean()) / pdf[target].std(ddof=0)).to_numpy()
        beta = np.linalg.solve(x.T @ x + np.eye(4), x.T @ y)
        assert [coef[(target, t)] for t in ["intercept", "co2", "energy", "population"]] == pytest.approx(
            list(beta), abs=1e-9)
        rss = float(np.sum((x @ beta - y) ** 2))
        se = np.sqrt(rss / (len(y) - 8) / float(np.sum((x - x.mean()) ** 2)))
        assert tests[(target, "co2")].se == pytest.approx(se, rel=1e-8)


def test_pooled_spread_closed_form():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(60, 3))
    z = (z - z.mean(0)) / z.std(0)
    x = np.c_[np.ones(60), z]
    assert float(np.sum((x - x.mean()) ** 2)) == pytest.approx(225.0)
    assert 60 * (4 - 1 / 4) == pytest.approx(225.0)


def test_pooled_predictions_match_dense(spark):
    pdf = _panel(spark).toPandas().sort_values(["country_code", "year"]).reset_index(drop=True)
    ref = _dense_build(pdf)
    got = pooled_predictions(_panel(spark)).toPandas().sort_values(["country_code", "year"])
    for target in ["temperature", "precipitation"]:
        pred, sq = ref["pred_" + target]
        assert got[f"pred_{target}"].to_numpy() == pytest.approx(pred, abs=1e-8)
        assert got[f"sq_err_{target}"].to_numpy() == pytest.approx(sq, abs=1e-8)


def _many_entities(spark, entities):
    """An unbalanced panel: three to five of five years an entity."""
    from pyspark.sql import functions as F

    def noise(k):
        return (F.pmod(F.xxhash64("e", "year", F.lit(k)), F.lit(100_003)) / 100_003.0).alias(f"u{k}")

    rows = spark.range(entities).select(F.format_string("E%07d", F.col("id")).alias("e"), F.explode(F.sequence(F.lit(2000), F.lit(2004))).alias("year"))
    rows = rows.where((F.col("year") < 2003) | (F.pmod(F.xxhash64("e", "year"), F.lit(3)) > 0)).select("e", "year", *[noise(k) for k in range(5)])
    level = F.pmod(F.xxhash64("e"), F.lit(1009)) / 1009.0
    return rows.select(F.col("e").alias("country_code"), "year", (F.col("u0") + 2 * level).alias("co2"), (F.col("u1") - level).alias("energy"),
                       F.col("u2").alias("population"), (F.col("u3") + F.col("u0") + 3 * level + F.col("year") / 10).alias("temperature"),
                       (F.col("u4") - 2 * level).alias("precipitation"))


@pytest.mark.parametrize("lam", [1.0, 0.01])
def test_pooled_effects_unbalanced_match_dense(spark, lam):
    panel = _many_entities(spark, 120)
    ref = _dense_build(panel.toPandas(), lam)
    coef, tests = pooled_effects(panel, lam=lam)
    coef = {(r.target, r.term): r.beta for r in coef.collect()}
    for target in ["temperature", "precipitation"]:
        beta, se, names = ref[target]
        assert len(names) == 119 + 4 + 3
        for name, b in zip(names, beta[1:]):
            assert coef[(target, name)] == pytest.approx(b, abs=1e-8)
    for r in tests.collect():
        assert r.se == pytest.approx(ref[r.target][1], rel=1e-8)


def test_pooled_effects_of_a_hundred_thousand_entities(spark):
    """The normal equations of every entity hold; nothing as large as the entities is on the driver."""
    from pyspark.sql import functions as F

    lam = 1.0
    panel = _many_entities(spark, 100_000).persist()
    fit = fit_pooled(panel, lam=lam)
    assert fit.effects.count() == 99_999
    n = panel.count()
    stats = panel.agg(F.avg("temperature").alias("m"), F.stddev_pop("temperature").alias("s")).first()
    predicted = pooled_predictions(panel, fit=fit).join(panel.select("country_code", "year", "temperature"), ["country_code", "year"])
    left = (F.col("temperature") - stats["m"]) / stats["s"] - F.col("pred_temperature")
    each = predicted.groupBy("country_code").agg(F.sum(left).alias("left"), F.count("*").alias("rows")).join(fit.effects, "country_code")
    worst, everything = each.agg(F.max(F.abs(F.col("left") / F.col("sd") - lam * F.col("b_temperature"))), F.sum("rows")).first()
    assert everything > 0.99 * n and worst < 1e-6
    rss = predicted.agg(F.sum(left * left)).first()[0]
    assert fit.rss["temperature"] == pytest.approx(rss, rel=1e-9)
    panel.unpersist()


def test_pooled_effects_of_one_entity_or_one_period(spark):
    panel = _many_entities(spark, 60)
    for part in (panel.where("year = 2001"), panel.where("country_code = 'E0000007' OR country_code = 'E0000009'")):
        pdf = part.toPandas()
        ref = _dense_build(pdf) if len(set(pdf.year)) > 1 else None
        coef, _ = pooled_effects(part)
        got = {(r.target, r.term): r.beta for r in coef.collect()}
        if ref:
            beta, _, names = ref["temperature"]
            assert [got[("temperature", name)] for name in names] == pytest.approx(list(beta[1:]), abs=1e-8)
        else:
            assert len(got) == 2 * (1 + 59 + 3) and all(np.isfinite(list(got.values())))
