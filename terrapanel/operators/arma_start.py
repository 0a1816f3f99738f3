"""Starting values of seasonal models: a two-stage regression as distributed Gram aggregates.

Stage one regresses the differenced series on its own last months (a long autoregression) and
takes the residuals as innovations; stage two regresses it on the lags that the order names,
of the series (ar) and of those innovations (ma).  A lag is a row sent to the month that looks
back at it and met there by an aggregate, so one very long series spreads over as many tasks as a
thousand short ones; sums of products are pre-aggregated where they arise, and only a square
of as many rows as the order has terms is solved, by elimination in array arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.operators.series import MONTH, SERIES, VALUE
from terrapanel.session import cut_lineage

#: A pivot under this share of its column's own sum of squares counts as none.
PIVOT_SHARE = 1e-10
_LABEL = "order_label"


def _lag_plan(orders: DataFrame) -> DataFrame:
    """Lags that an order looks back at: ``_diff`` (lag, c), ``_own`` (long autoregression), ``_ar``, ``_ma``."""
    fields = {f"{f}s": f"filter(sequence(0, {f}), i -> i > 0)" for f in ("ar", "sar", "ma", "sma")}
    plain = orders.withColumns({f"_{k}": F.expr(v) for k, v in fields.items()})
    binomial = "factorial({n}) / (factorial({k}) * factorial({n} - {k}))".format
    return plain.withColumns({
        "_diff": F.expr(
            "flatten(transform(sequence(0, diff), i -> transform(sequence(0, sdiff), j -> struct("
            f"i + season * j AS lag, pow(-1, i + j) * ({binomial(n='diff', k='i')}) * ({binomial(n='sdiff', k='j')}) AS c))))"),
        "_own": F.expr("filter(sequence(0, ma + season * sma), i -> i > 0)"),
        "_ar": F.expr("array_distinct(concat(_ars, transform(_sars, k -> k * season)))"),
        "_ma": F.expr("array_distinct(concat(_mas, transform(_smas, k -> k * season)))"),
    }).drop(*[f"_{k}" for k in fields])


def _met(cells: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Sent cells (ids, t, size, place, v) by month: ``x`` (target first), only where all of them arrived."""
    met = cells.groupBy(*ids, "t").agg(F.sort_array(F.collect_list(F.struct("place", "v"))).alias("_x"), F.first("size").alias("_n"))
    return met.where(F.size("_x") == F.col("_n")).select(*ids, "t", F.transform("_x", lambda s: s["v"]).alias("x"))


def _regress(met: DataFrame, ids: Sequence[str]) -> DataFrame:
    """ids, coefs, n_rows: least squares of x[0] on the rest; coefs are null where a pivot vanishes."""
    products = met.select(*ids, F.expr(
        "explode(flatten(transform(sequence(1, size(x) - 1), i -> transform(sequence(0, size(x) - 1), "
        "j -> struct(i, j, x[i] * x[j] AS v))))) AS p")).select(*ids, "p.*")
    entries = products.groupBy(*ids, "i", "j").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    lines = entries.groupBy(*ids, "i").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("j", "v"))), lambda s: s["v"]).alias("line"), F.first("n").alias("n"))
    square = lines.groupBy(*ids).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "line"))), lambda s: s["line"]).alias("m"), F.first("n").alias("n_rows"))
    # m[i - 1][0] is the right-hand side, m[i - 1][j] the sum of x_i x_j.  Gauss-Jordan on the diagonal: the square is
    # positive semidefinite, so a vanishing pivot is a dependent column.
    pivot = f"nullif(if(m[s - 1][s] > {PIVOT_SHARE!r} * d[s - 1], m[s - 1][s], 0D), 0D)"
    step = (f"transform(m, (row, r) -> if(r = s - 1, transform(row, v -> v / {pivot}), "
            f"transform(row, (v, c) -> v - row[s] * m[s - 1][c] / {pivot})))")
    solved = square.withColumn("d", F.expr("transform(m, (row, r) -> row[r + 1])"))
    return solved.select(*ids, "n_rows", F.expr(
        f"transform(aggregate(sequence(1, size(m)), m, (m, s) -> {step}), row -> row[0])").alias("coefs"))


def _sent(rows: DataFrame, lags: Column, size: Column, v: str, ids: Sequence[str], first: Column | None = None) -> DataFrame:
    """Each row's value at the months ``lags`` later, as regressors numbered from ``first``."""
    first = F.lit(0) if first is None else first
    return rows.select(*ids, "t", F.col(v).alias("v"), size.alias("size"), first.alias("_first"), F.posexplode(lags).alias("_k", "_lag")).select(
        *ids, (F.col("t") + F.col("_lag")).alias("t"), "size", (F.col("_first") + F.col("_k")).alias("place"), "v")


def arma_start(train: DataFrame, orders: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Starting values for each series and order: keys..., series, order_label, part ('ar', 'ma'), lag, start, n_rows.

    ``train`` is (keys..., series, month, value), ``orders`` an order table.  Seasonal terms stand at their lag
    in months.  A month that is missing, null or there twice takes out the regressions that look at it, nothing
    is shifted.  ``start`` is null where fewer rows than terms are left or where terms are linearly dependent.
    """
    names = {k: f"_key{i}" for i, k in enumerate(keys)}     # a key may have any name, also one used here
    found = _arma_start(train.withColumnsRenamed(names), orders.withColumnsRenamed(names), list(names.values()))
    return found.withColumnsRenamed({v: k for k, v in names.items()})


def _arma_start(train: DataFrame, orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    ids = [*keys, SERIES, _LABEL]
    on = [c for c in [*keys, SERIES] if c in orders.columns]
    plan = _lag_plan(orders).select(*on, _LABEL, "_diff", "_own", "_ar", "_ma")
    t = (F.year(MONTH) * 12 + F.month(MONTH)).cast("int")
    raw = train.select(*keys, SERIES, t.alias("t"), VALUE).join(plan.select(*on, _LABEL, "_diff"), on)
    parts = raw.select(*ids, "t", VALUE, F.size("_diff").alias("_n"), F.explode("_diff").alias("_d")).select(
        *ids, (F.col("t") + F.col("_d.lag")).alias("t"), "_n", (F.col("_d.c") * F.col(VALUE)).alias("v"))
    w = parts.groupBy(*ids, "t").agg(F.sum("v").alias("w"), F.count("v").alias("_seen"), F.count("*").alias("_sent"), F.first("_n").alias("_n"))
    w = w.where((F.col("_seen") == F.col("_n")) & (F.col("_sent") == F.col("_n"))).select(*ids, "t", "w")
    terms = plan.select(*on, _LABEL, "_own", "_ar", "_ma")
    w = cut_lineage(w.join(terms, [*on, _LABEL]).select(*ids, "t", "w", "_own", "_ar", "_ma"))

    here = F.array(F.lit(0))
    own_size = F.size("_own") + 1
    long_ar = _met(_sent(w.where(F.size("_own") > 0), F.concat(here, "_own"), own_size, "w", ids), ids)
    first = _regress(long_ar, ids).where("n_rows > size(coefs)")
    shocks = long_ar.join(first, ids).select(*ids, "t", F.expr(
        "x[0] - aggregate(zip_with(slice(x, 2, size(x) - 1), coefs, (a, b) -> a * b), 0D, (s, v) -> s + v)").alias("e"))
    shocks = shocks.where("e IS NOT NULL").join(terms, [*on, _LABEL]).select(*ids, "t", "e", "_ar", "_ma")

    size = F.size("_ar") + F.size("_ma") + 1
    cells = _sent(w, F.concat(here, "_ar"), size, "w", ids).unionByName(
        _sent(shocks, F.col("_ma"), size, "e", ids, F.size("_ar") + 1))
    second = _regress(_met(cells, ids).where("size(x) > 1"), ids)
    wanted = train.select(*keys, SERIES).distinct().join(terms, on).select(
        *ids, F.posexplode(F.concat(F.transform("_ar", lambda k: F.struct(F.lit("ar").alias("part"), k.alias("lag"))),
                                    F.transform("_ma", lambda k: F.struct(F.lit("ma").alias("part"), k.alias("lag"))))).alias("_i", "_term"))
    same = F.lit(True)
    for c in ids:
        same = same & F.col(f"w.{c}").eqNullSafe(F.col(f"s.{c}"))
    return wanted.alias("w").join(second.alias("s"), same, "left").select(
        *[F.col(f"w.{c}") for c in ids], "_term.part", "_term.lag",
        F.when(F.col("n_rows") > F.size("coefs"), F.get("coefs", F.col("_i"))).alias("start"),
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))
