"""Regressions from sufficient statistics.

No design matrix is ever built.  Per-group OLS and the three-factor ridge are
solved by Gaussian elimination written as column arithmetic on the moment
table (one row per group), so thousands of groups solve in one codegen'd
projection.  The fixed-effects ridge with country and year dummies eliminates the
countries by one aggregate, whatever their number; the driver solves what is
left, a system of years and factors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.functions.stats import apply_stages, min_norm_stages, solve_stages, with_t_tail
from terrapanel.operators.series import _ship_code_with_udfs as ship_code
from terrapanel.operators.stats import corr_sql, cov_col, mean_col, moments, sd_col
from terrapanel.session import cut_lineage

GROUP_TARGET = "temperature"
GROUP_FACTORS = ("co2", "precipitation", "energy", "population")
POOLED_TARGETS = ("temperature", "precipitation")
POOLED_FACTORS = ("co2", "energy", "population")
# Columns of the joined panel (country, year, two targets, three factors):
# the studied test statistic uses this count for its degrees of freedom.
PANEL_COLUMNS = 7


def _dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def group_betas(
    panel: DataFrame,
    target: str = GROUP_TARGET,
    factors: Sequence[str] = GROUP_FACTORS,
    by: str = "country_code",
    tol: float = 1e-10,
    rank_deficient: str = "null",
) -> DataFrame:
    """Per-group OLS of standardised ``target`` on standardised ``factors`` with intercept.

    Standardising within the group (ddof 0) turns the normal equations into
    the correlation system R b = r, and the intercept is 0 by construction.
    One ``groupBy`` gathers count, means, sds and covariances; the solve is a
    projection over that one-row-per-group table.  In a group of dependent
    factors (as one with too few rows) the unknowns without a pivot come out NULL, or
    with ``rank_deficient='pinv'`` the group has the smallest of all least-squares
    solutions, as a pseudo-inverse gives it; ``'min_norm'`` gives the same in column arithmetic, without
    Python workers.  A constant measure has no z-score: NULL.
    """
    if rank_deficient not in ("null", "pinv", "min_norm"):
        raise ValueError(f"rank_deficient must be 'null', 'pinv' or 'min_norm', not {rank_deficient!r}")
    factors = list(factors)
    cols = [target] + factors
    m = moments(panel, cols, [by])
    k = len(factors)
    a = [[corr_sql(factors[i], factors[j], cols) for j in range(k)] for i in range(k)]
    rhs = [[corr_sql(f, target, cols) for f in factors]]
    stages, sol = solve_stages(a, rhs, prefix="_gb_", tol=tol)
    solved = apply_stages(m, stages)
    if rank_deficient == "pinv":
        matrix = F.array(*[F.expr(f"CAST({a[i][j]} AS DOUBLE)") for i in range(k) for j in range(k)])
        right = F.array(*[F.expr(f"CAST({x} AS DOUBLE)") for x in rhs[0]])
        found = F.array(*[F.col(c).cast("double") for c in sol[0]])
        return _with_pinv(solved.select(by, found.alias("_b"), matrix.alias("_a"), right.alias("_r")), by, factors, tol)
    first = F.col(sol[0][0])
    unknowns = [F.col(c) for c in sol[0]]
    if rank_deficient == "min_norm":
        more, smallest = min_norm_stages(a, rhs[0], prefix="_mn_")
        solved = apply_stages(solved, more)
        unknowns = [F.when(first.isNotNull(), u).otherwise(F.col(c)) for u, c in zip(unknowns, smallest)]
    return solved.select(
        by,
        F.when(unknowns[0].isNotNull(), F.lit(0.0)).alias("intercept"),
        *[u.alias(f) for u, f in zip(unknowns, factors)],
    )


def _with_pinv(systems: DataFrame, by: str, factors: list[str], tol: float) -> DataFrame:
    """Coefficients of ``systems`` (by, _b, _a, _r; a row a group); groups without a full ``_b`` by pseudo-inverse."""
    k = len(factors)

    def run(frames):
        for frame in frames:
            b, a, r = (np.array([[np.nan if v is None else v for v in x] for x in frame[c]], float).reshape(len(frame), n)
                       for c, n in (("_b", k), ("_a", k * k), ("_r", k)))
            known = np.isfinite(a).all(axis=1) & np.isfinite(r).all(axis=1)
            open_ = known & ~np.isfinite(b).all(axis=1)
            if open_.any():
                inverse = np.linalg.pinv(a[open_].reshape(-1, k, k), rcond=tol, hermitian=True)
                b[open_] = np.einsum("gij,gj->gi", inverse, r[open_])
            out = frame[[by]].copy()
            out["_x"] = [[None if v != v else v for v in row] for row in b.tolist()]
            yield out

    ship_code()
    key = systems.schema[by].dataType.simpleString()
    solved = systems.mapInPandas(run, f"`{by}` {key}, _x array<double>")
    whole = F.forall("_x", lambda v: v.isNotNull())
    return solved.select(by, F.when(whole, F.lit(0.0)).alias("intercept"), *[F.col("_x")[i].alias(f) for i, f in enumerate(factors)])


def ridge_stages(
    targets: Sequence[str],
    factors: Sequence[str],
    lam: float,
    tol: float = 1e-10,
) -> tuple[list[dict[str, str]], list[list[str]], dict[str, str]]:
    """Solve stages of the z-scored ridge (X'X + lam I) b = X'y on a global moment row.

    With every column standardised, X'X = n R and X'y = n r; the bias column
    is orthogonal to them, so its coefficient is 0 / (n + lam) = 0.  Also
    returns SQL for each target's residual sum of squares, computed from the
    same statistics without a second pass over the rows.
    """
    cols = list(targets) + list(factors)
    k = len(factors)
    a = [[f"n * {corr_sql(factors[i], factors[j], cols)}" + (f" + {_dbl(lam)}" if i == j else "")
          for j in range(k)] for i in range(k)]
    rhs = [[f"n * {corr_sql(f, t, cols)}" for f in factors] for t in targets]
    stages, sol = solve_stages(a, rhs, prefix="_rf_", tol=tol)
    rss = {}
    for r, t in enumerate(targets):
        br = " + ".join(f"{sol[r][i]} * {corr_sql(f, t, cols)}" for i, f in enumerate(factors))
        brb = " + ".join(
            f"{sol[r][i]} * {sol[r][j]} * {corr_sql(factors[i], factors[j], cols)}"
            for i in range(k) for j in range(k))
        rss[t] = f"n - 2 * n * ({br}) + n * ({brb})"
    return stages, sol, rss


def _explode_rows(df: DataFrame, rows: list[list], names: list[str]) -> DataFrame:
    structs = [F.struct(*[v.alias(nm) for v, nm in zip(row, names)]) for row in rows]
    return df.select(F.inline(F.array(*structs)))


def ridge_fit(
    panel: DataFrame,
    targets: Sequence[str] = POOLED_TARGETS,
    factors: Sequence[str] = POOLED_FACTORS,
    lam: float = 1.0,
) -> DataFrame:
    """Ridge coefficients (target, term, beta) of the z-scored model with a bias column."""
    targets, factors = list(targets), list(factors)
    stages, sol, _ = ridge_stages(targets, factors, lam)
    solved = apply_stages(moments(panel, targets + factors), stages)
    rows = []
    for r, t in enumerate(targets):
        rows.append([F.lit(t), F.lit("intercept"),
                     F.when(F.col(sol[r][0]).isNotNull(), F.lit(0.0))])
        for i, f in enumerate(factors):
            rows.append([F.lit(t), F.lit(f), F.col(sol[r][i])])
    return _explode_rows(solved, rows, ["target", "term", "beta"])


def ridge_tests(
    panel: DataFrame,
    targets: Sequence[str] = POOLED_TARGETS,
    factors: Sequence[str] = POOLED_FACTORS,
    lam: float = 1.0,
    alpha: float = 0.05,
    decision_tail: str = "one",
    panel_columns: int = PANEL_COLUMNS,
) -> DataFrame:
    """t statistics, p-values and accept/reject decisions for every (target, factor).

    Follows the studied statistic: dof = n - (panel columns + 1); one pooled
    standard error sqrt(s^2 / V) where V, the spread of all cells of the
    z-scored design with its bias column, is n((p+1) - 1/(p+1)) in closed
    form; one-sided tail for the decision, two-sided value reported too.
    """
    targets, factors = list(targets), list(factors)
    stages, sol, rss = ridge_stages(targets, factors, lam)
    solved = apply_stages(moments(panel, targets + factors), stages)
    p = len(factors)
    spread = (p + 1) - 1.0 / (p + 1)
    dof = f"(n - {panel_columns + 1})"
    solved = solved.withColumns({
        f"_se_{t}": F.expr(
            f"CASE WHEN {dof} > 0 THEN sqrt(({rss[t]}) / {dof} / (n * {_dbl(spread)})) END")
        for t in targets
    })
    rows = []
    for r, t in enumerate(targets):
        for i, f in enumerate(factors):
            rows.append([F.lit(t), F.lit(f), F.col(sol[r][i]), F.col(f"_se_{t}"),
                         F.expr(dof).cast("long")])
    out = _explode_rows(solved, rows, ["target", "factor", "beta", "se", "dof"])
    return finish_tests(out, alpha, decision_tail)


def finish_tests(tests: DataFrame, alpha: float = 0.05, decision_tail: str = "one") -> DataFrame:
    """Add t, one/two-sided p-values and the decision to (beta, se, dof) rows."""
    out = tests.withColumn("t", F.when(F.col("se") > 0, F.col("beta") / F.col("se")))
    out = with_t_tail(out, "t", "dof", "p_one_sided")
    out = out.withColumn("p_two_sided", 2 * F.col("p_one_sided"))
    p = F.col("p_one_sided") if decision_tail == "one" else F.col("p_two_sided")
    return out.withColumn("decision", F.when(p < alpha, "reject").otherwise("accept"))


def ridge_predictions(
    panel: DataFrame,
    targets: Sequence[str] = POOLED_TARGETS,
    factors: Sequence[str] = POOLED_FACTORS,
    lam: float = 1.0,
    keys: Sequence[str] = ("country_code", "year"),
) -> DataFrame:
    """Per-row fitted values (z units) and squared residuals of the three-factor ridge.

    Coefficients, means and sds enter as scalar subqueries that Spark merges
    into one job and inlines as constants, so the rows are streamed once
    with no join or shuffle.
    """
    targets, factors = list(targets), list(factors)
    stages, sol, _ = ridge_stages(targets, factors, lam)
    stats = apply_stages(moments(panel, targets + factors), stages)

    def scalar(col: str):
        return stats.select(F.col(col)).scalar()

    z = {c: (F.col(c) - scalar(mean_col(c))) / scalar(sd_col(c)) for c in targets + factors}
    out = panel.select(*keys, *[z[c].alias(f"z_{c}") for c in targets + factors])
    fitted = {}
    for r, t in enumerate(targets):
        pred = sum((scalar(sol[r][i]) * F.col(f"z_{f}") for i, f in enumerate(factors)), F.lit(0.0))
        fitted[f"pred_{t}"] = pred
    out = out.withColumns(fitted)
    out = out.withColumns({f"sq_err_{t}": F.pow(F.col(f"pred_{t}") - F.col(f"z_{t}"), 2)
                           for t in targets})
    return out.select(*keys, *[f"pred_{t}" for t in targets], *[f"sq_err_{t}" for t in targets])


# --------------------------------------------------------------------------
# Fixed-effects ridge with country and year dummies
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class PooledFit:
    """A solved fixed-effects ridge: what is as large as the entities stays a DataFrame, the rest is small.

    ``effects`` has one row an entity but the first (its reference): the entity, ``sd`` of its dummy and
    ``b_<target>``; ``periods`` and ``factors`` map a level or factor to its coefficient a target.
    """

    targets: list[str]
    factor_names: list[str]
    entity: str
    period: str
    effects: DataFrame
    periods: dict
    factors: dict
    period_sd: dict
    constant: dict
    rss: dict
    n: int
    p: int
    dof: int
    glob: dict


def _entity_table(panel: DataFrame, cols: Sequence[str], glob: dict, entity: str, period: str) -> tuple[DataFrame, list]:
    """One row an entity (rows, sums of z-scores, rows by period), written; and one row a period on the driver."""
    z = [F.sum((F.col(c) - F.lit(glob[mean_col(c)])) / F.lit(glob[sd_col(c)])).alias(c) for c in cols]
    cells = cut_lineage(panel.groupBy(entity, period).agg(F.count(F.lit(1)).alias("_n"), *z))
    totals = [F.sum("_n").alias("_n"), *[F.sum(c).alias(c) for c in cols]]
    by_period = F.map_from_entries(F.collect_list(F.struct(F.col(period), F.col("_n")))).alias("_by")
    return cut_lineage(cells.groupBy(entity).agg(*totals, by_period)), cells.groupBy(period).agg(*totals).orderBy(period).collect()


def _weighted_products(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of w v v' and of m w v over rows (w, m, v): numpy in each task, ``width`` squared numbers leave it."""
    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width + 1, width))
        for frame in frames:
            for at in range(0, len(frame), 4096):
                part = frame.iloc[at : at + 4096]
                v, w, m = np.vstack(part["v"].to_numpy()), part["w"].to_numpy(), part["m"].to_numpy()
                total[:width] += (v * w[:, None]).T @ v
                total[width] += (m * w) @ v
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "x": total.ravel()})

    parts = vectors.mapInPandas(run, "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    out = np.zeros((width + 1, width))
    for r in parts.collect():  # width squared rows, whatever the number of entities
        out[r["i"], r["j"]] = r["x"]
    return out[:width], out[width]


def fit_pooled(
    panel: DataFrame,
    targets: Sequence[str] = POOLED_TARGETS,
    factors: Sequence[str] = POOLED_FACTORS,
    entity: str = "country_code",
    period: str = "year",
    lam: float = 1.0,
    panel_columns: int = PANEL_COLUMNS,
) -> PooledFit:
    """Ridge on z-scored entity and period dummies (drop-first levels) and factors, by block elimination.

    The entities' block of the normal equations is a diagonal minus a rank-one matrix, so its inverse is known in
    closed form and one aggregate over the entities gives the Schur complement of everything
    else.  Only that system, of periods and factors, is solved on the driver; entity effects come back
    as an expression over the entity table.  The number of entities is free, that of periods
    is bounded by the time axis (their square is held).
    """
    targets, factors = list(targets), list(factors)
    cols = factors + targets
    glob = moments(panel, cols).first().asDict()
    n = float(glob["n"])
    table, periods = _entity_table(panel, cols, glob, entity, period)
    first = table.agg(F.min(entity)).first()[0]
    levels = [r[period] for r in periods][1:]
    m_p = np.array([r["_n"] for r in periods][1:]) / n
    s_p = np.sqrt(m_p * (1 - m_p))
    q, width = len(levels) + len(factors), len(levels) + len(cols)

    # Everything but the entities: products of z-scored columns, targets last.
    corr = np.array([[1.0 if a == b else glob[cov_col(*sorted((a, b), key=cols.index))] / (glob[sd_col(a)] * glob[sd_col(b)])
                      for b in cols] for a in cols])
    rest = np.zeros((width, width))
    rest[: len(levels), : len(levels)] = n * (np.diag(m_p) - np.outer(m_p, m_p)) / np.outer(s_p, s_p)
    sums = np.array([[r[c] for c in cols] for r in periods][1:]).reshape(len(levels), len(cols))
    rest[: len(levels), len(levels) :] = sums / s_p[:, None]
    rest[len(levels) :, : len(levels)] = rest[: len(levels), len(levels) :].T
    rest[len(levels) :, len(levels) :] = n * corr

    # An entity's row of products with all of these, times its dummy's sd; w and m are its weight and share.
    share = F.col("_n") / F.lit(n)
    weight = F.lit(1.0) / (share * (F.lit(n) + F.lit(float(lam)) * (F.lit(1.0) - share)))
    dummies = [(F.coalesce(F.element_at("_by", F.lit(v)).cast("double"), F.lit(0.0)) - F.col("_n") * F.lit(float(mu))) / F.lit(float(sd))
               for v, mu, sd in zip(levels, m_p, s_p, strict=True)]
    vector = F.array(*dummies, *[F.col(c).cast("double") for c in cols])
    others = table.where(F.col(entity) != F.lit(first)).select(entity, weight.alias("w"), share.alias("m"), vector.alias("v"))
    gram, h = _weighted_products(others.select("w", "m", "v"), width)
    # One minus the rank-one part's own product, without the cancellation.
    held = F.sum(F.col("m") * F.col("m") * F.col("w") * (F.lit(1.0) - F.col("m")))
    first_share = table.where(F.col(entity) == F.lit(first)).agg(F.sum("_n")).first()[0] / n
    delta = first_share + lam * (others.agg(held).first()[0] or 0.0)

    schur = rest - gram - n * np.outer(h, h) / delta
    solved = np.linalg.solve(schur[:q, :q] + lam * np.eye(q), schur[:q, q:])
    effects, constant, dots = others, {}, []
    sd = F.sqrt(F.col("m") * (F.lit(1.0) - F.col("m")))
    for k, t in enumerate(targets):
        b = solved[:, k]
        g = float(h[q + k] - h[:q] @ b)
        # Weights of the vector whose product is what the other terms leave of the target.
        left = np.concatenate([-b, np.eye(len(targets))[k]])
        rows = F.zip_with("v", F.array(*[F.lit(float(x)) for x in left]), lambda x, y: x * y)
        tau = F.aggregate(rows, F.lit(0.0), lambda a, x: a + x)
        effects = effects.withColumn(f"b_{t}", F.col("w") * sd * (tau + F.lit(n * g / delta) * F.col("m")))
        constant[t] = -g / delta - float(b[: len(levels)] @ (m_p / s_p)) if len(levels) else -g / delta
        dots += [F.sum(F.col(f"b_{t}") * F.col("v")[q + k] / sd).alias(f"dot_{t}"), F.sum(F.col(f"b_{t}") ** 2).alias(f"sq_{t}")]
    effects = cut_lineage(effects.withColumn("sd", sd))
    sums = effects.agg(*dots).first()
    rss = {}
    for k, t in enumerate(targets):
        b = solved[:, k]
        # The residuals' squares by the normal equations: y'y - b'r - lam b'b.
        rss[t] = n - float(b @ rest[:q, q + k]) - (sums[f"dot_{t}"] or 0.0) - lam * (float(b @ b) + (sums[f"sq_{t}"] or 0.0))
    entities = table.count()
    return PooledFit(
        targets, factors, entity, period, effects.select(entity, "sd", *[f"b_{t}" for t in targets]),
        {v: {t: float(solved[i, k]) for k, t in enumerate(targets)} for i, v in enumerate(levels)},
        {f: {t: float(solved[len(levels) + i, k]) for k, t in enumerate(targets)} for i, f in enumerate(factors)},
        dict(zip(levels, map(float, s_p), strict=True)), constant, rss, int(n), entities - 1 + q, int(n) - (panel_columns + 1), glob)


def pooled_effects(
    panel: DataFrame,
    targets: Sequence[str] = POOLED_TARGETS,
    factors: Sequence[str] = POOLED_FACTORS,
    entity: str = "country_code",
    period: str = "year",
    lam: float = 1.0,
    alpha: float = 0.05,
    decision_tail: str = "one",
    panel_columns: int = PANEL_COLUMNS,
    fit: PooledFit | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Fixed-effects ridge with drop-first country and year dummies.

    Returns ``(coefficients, tests)``: coefficients (target, term, beta) for
    the intercept, every dummy and every factor; tests as in
    :func:`ridge_tests` for the factors.  ``fit`` is a solution to be used again.
    """
    spark = panel.sparkSession
    fit = fit or fit_pooled(panel, targets, factors, entity, period, lam, panel_columns)
    small, test_rows = [], []
    spread = fit.n * ((fit.p + 1) - 1.0 / (fit.p + 1))
    for t in fit.targets:
        small.append((t, "intercept", 0.0))
        small += [(t, f"YEAR_{v}", b[t]) for v, b in fit.periods.items()]
        small += [(t, f, b[t]) for f, b in fit.factors.items()]
        se = float(np.sqrt(fit.rss[t] / fit.dof / spread)) if fit.dof > 0 else None
        test_rows += [(t, f, b[t], se, fit.dof) for f, b in fit.factors.items()]
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.concat(F.lit("CC_"), F.col(fit.entity).cast("string")).alias("term"),
                                        F.col(f"b_{t}").alias("beta")) for t in fit.targets]))
    coefficients = spark.createDataFrame(small, "target string, term string, beta double").unionByName(
        fit.effects.select(each.alias("x")).select("x.*"))
    schema = "target string, factor string, beta double, se double, dof long"
    return coefficients, finish_tests(spark.createDataFrame(test_rows, schema), alpha, decision_tail)


def pooled_predictions(
    panel: DataFrame,
    targets: Sequence[str] = POOLED_TARGETS,
    factors: Sequence[str] = POOLED_FACTORS,
    entity: str = "country_code",
    period: str = "year",
    lam: float = 1.0,
    panel_columns: int = PANEL_COLUMNS,
    fit: PooledFit | None = None,
) -> DataFrame:
    """Fitted values (z units) and squared residuals of the fixed-effects ridge, per panel row.

    With standardised dummies the fit is a constant plus one effect per
    country and one per year plus the factor terms: entity effects are joined by
    their key, years and factors are constants of the expression.
    """
    fit = fit or fit_pooled(panel, targets, factors, entity, period, lam, panel_columns)
    effects = fit.effects.select(fit.entity, *[(F.col(f"b_{t}") / F.col("sd")).alias(f"_eff_{t}") for t in fit.targets])
    out = panel.join(effects, fit.entity, "left")
    cols = {}
    for t in fit.targets:
        pred = F.lit(fit.constant[t]) + F.coalesce(F.col(f"_eff_{t}"), F.lit(0.0))
        if fit.periods:
            by_year = F.create_map(*[F.lit(x) for v, b in fit.periods.items() for x in (v, b[t] / fit.period_sd[v])])
            pred = pred + F.coalesce(F.element_at(by_year, F.col(fit.period)), F.lit(0.0))
        for f, b in fit.factors.items():
            pred = pred + F.lit(b[t]) * (F.col(f) - fit.glob[mean_col(f)]) / fit.glob[sd_col(f)]
        z_t = (F.col(t) - fit.glob[mean_col(t)]) / fit.glob[sd_col(t)]
        cols[f"pred_{t}"] = pred
        cols[f"sq_err_{t}"] = F.pow(pred - z_t, 2)
    return out.select(fit.entity, fit.period, *[e.alias(c) for c, e in cols.items()])
