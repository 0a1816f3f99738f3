"""Statistical column expressions that stay inside the JVM.

Both the Student-t tail and the small linear solves are written as SQL
arithmetic, so a whole table of them is evaluated by whole-stage codegen and
the same text runs unchanged as a check on another SQL engine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIMPSON_INTERVALS = 2000
# The integrand cos^(nu-1) is negligible beyond 40/sqrt(nu) radians past its
# lower end, so integrating over that span keeps Simpson's rule accurate for
# large degrees of freedom.
TAIL_SPAN = 40.0
DOUBLE_ZERO = "CAST(0 AS DOUBLE)"
DOUBLE_ONE = "CAST(1 AS DOUBLE)"


def _simpson_term(lower: str, step: str, power: str, var: str) -> str:
    n = SIMPSON_INTERVALS
    weight = f"(CASE WHEN {var} = 0 OR {var} = {n} THEN 1 WHEN {var} % 2 = 1 THEN 4 ELSE 2 END)"
    return f"{weight} * pow(greatest(cos({lower} + {var} * {step}), {DOUBLE_ZERO}), {power})"


def t_tail_sql(t: str, dof: str, dialect: str = "spark") -> str:
    """SQL for the upper tail P(T > |t|) of Student's t with ``dof`` degrees of freedom.

    With t = sqrt(nu)*tan(theta) the density becomes cos^(nu-1)(theta), so
    P(T > t) = 0.5 * int_a^{pi/2} cos^(nu-1) / int_0^{pi/2} cos^(nu-1),
    a = atan(t/sqrt(nu)); both integrals by Simpson's rule.
    ``dialect`` is ``'spark'`` or ``'duckdb'`` (only the list fold differs).
    """
    n = SIMPSON_INTERVALS
    a = f"atan(abs({t}) / sqrt({dof}))"
    upper = f"least(pi() / 2, {a} + {TAIL_SPAN} / sqrt({dof}))"
    upper0 = f"least(pi() / 2, {TAIL_SPAN} / sqrt({dof}))"
    step = f"(({upper}) - ({a})) / {n}"
    step0 = f"({upper0}) / {n}"
    power = f"({dof} - 1)"
    term = _simpson_term(a, step, power, "i")
    term0 = _simpson_term(DOUBLE_ZERO, step0, power, "i")
    if dialect == "spark":
        num = f"aggregate(sequence(0, {n}), {DOUBLE_ZERO}, (acc, i) -> acc + {term})"
        den = f"aggregate(sequence(0, {n}), {DOUBLE_ZERO}, (acc, i) -> acc + {term0})"
    elif dialect == "duckdb":
        num = f"list_sum(list_transform(range(0, {n + 1}), lambda i: {term}))"
        den = f"list_sum(list_transform(range(0, {n + 1}), lambda i: {term0}))"
    else:
        raise ValueError(f"unknown dialect {dialect!r}")
    return f"(0.5 * ({num}) * ({step}) / (({den}) * ({step0})))"


def with_t_tail(df: DataFrame, t: str, dof: str, out: str) -> DataFrame:
    """Add ``out`` = P(T > |t|) for columns ``t`` and ``dof`` of ``df``."""
    return df.withColumn(out, F.expr(t_tail_sql(f"`{t}`", f"CAST(`{dof}` AS DOUBLE)")))


def solve_stages(
    matrix: Sequence[Sequence[str]],
    rhs: Sequence[Sequence[str]],
    prefix: str,
    tol: float = 1e-10,
) -> tuple[list[dict[str, str]], list[list[str]]]:
    """Gaussian elimination for a symmetric positive (semi)definite system.

    ``matrix`` holds SQL expressions for A (n x n), ``rhs`` one list of n
    expressions per right-hand side.  Returns ``(stages, solutions)``:
    ``stages`` is a list of {column: SQL} layers, each referring only to
    columns of earlier layers; ``solutions[r][i]`` names the column holding
    x_i for right-hand side r.  A pivot at or below ``tol`` makes the
    dependent unknowns NULL: rank deficiency is reported, never guessed.
    """
    n = len(matrix)
    nr = len(rhs)
    stages: list[dict[str, str]] = []
    first: dict[str, str] = {}
    for i in range(n):
        for j in range(n):
            first[f"{prefix}a0_{i}_{j}"] = f"({matrix[i][j]})"
    for r in range(nr):
        for i in range(n):
            first[f"{prefix}b0_{r}_{i}"] = f"({rhs[r][i]})"
    stages.append(first)
    inv = []
    for k in range(n):
        piv = f"{prefix}a{k}_{k}_{k}"
        inv_k = f"{prefix}inv{k}"
        stages.append({inv_k: f"CASE WHEN {piv} > {tol!r} THEN {DOUBLE_ONE} / {piv} END"})
        inv.append(inv_k)
        if k == n - 1:
            break
        nxt: dict[str, str] = {}
        for i in range(k + 1, n):
            factor = f"{prefix}a{k}_{i}_{k} * {inv_k}"
            for j in range(k + 1, n):
                nxt[f"{prefix}a{k + 1}_{i}_{j}"] = (
                    f"{prefix}a{k}_{i}_{j} - {factor} * {prefix}a{k}_{k}_{j}")
            for r in range(nr):
                nxt[f"{prefix}b{k + 1}_{r}_{i}"] = (
                    f"{prefix}b{k}_{r}_{i} - {factor} * {prefix}b{k}_{r}_{k}")
        stages.append(nxt)
    for i in reversed(range(n)):
        layer = {}
        for r in range(nr):
            acc = f"{prefix}b{i}_{r}_{i}"
            for j in range(i + 1, n):
                acc += f" - {prefix}a{i}_{i}_{j} * {prefix}x_{r}_{j}"
            layer[f"{prefix}x_{r}_{i}"] = f"({acc}) * {inv[i]}"
        stages.append(layer)
    solutions = [[f"{prefix}x_{r}_{i}" for i in range(n)] for r in range(nr)]
    return stages, solutions


def min_norm_stages(
    matrix: Sequence[Sequence[str]], rhs: Sequence[str], prefix: str, tol: float = 1e-9,
) -> tuple[list[dict[str, str]], list[str]]:
    """The smallest solution of A x = b for a symmetric semidefinite A with b in its range, as :func:`solve_stages`.

    Elimination without exchanges marks the columns C of A that carry its rank (pivot over ``tol``). A x = b has its
    smallest solution in the range of C: x = C y with C'C y = b restricted to those columns.  The others get a
    unit row, so one system of the full size serves every rank.  A null in A or b makes all unknowns null.
    """
    n = len(matrix)
    first = {f"{prefix}a0_{i}_{j}": f"({matrix[i][j]})" for i in range(n) for j in range(n)}
    first |= {f"{prefix}r_{i}": f"({rhs[i]})" for i in range(n)}
    stages = [first]
    for k in range(n):
        piv = f"{prefix}a{k}_{k}_{k}"
        stages.append({f"{prefix}m_{k}": f"CASE WHEN {piv} > {tol!r} THEN {DOUBLE_ONE} ELSE {DOUBLE_ZERO} END",
                       f"{prefix}i_{k}": f"CASE WHEN {piv} > {tol!r} THEN {DOUBLE_ONE} / {piv} ELSE {DOUBLE_ZERO} END"})
        if k < n - 1:
            stages.append({
                f"{prefix}a{k + 1}_{i}_{j}":
                    f"{prefix}a{k}_{i}_{j} - {prefix}a{k}_{i}_{k} * {prefix}i_{k} * {prefix}a{k}_{k}_{j}"
                for i in range(k + 1, n) for j in range(k + 1, n)})
    products = {}
    for i in range(n):
        for j in range(n):
            dot = " + ".join(f"{prefix}a0_{l}_{i} * {prefix}a0_{l}_{j}" for l in range(n))
            unit = f" + {DOUBLE_ONE} - {prefix}m_{i}" if i == j else ""
            products[f"{prefix}g_{i}_{j}"] = f"({dot}) * {prefix}m_{i} * {prefix}m_{j}{unit}"
    products |= {f"{prefix}h_{i}": f"{prefix}m_{i} * {prefix}r_{i}" for i in range(n)}
    stages.append(products)
    inner, found = solve_stages(
        [[f"{prefix}g_{i}_{j}" for j in range(n)] for i in range(n)], [[f"{prefix}h_{i}" for i in range(n)]], f"{prefix}y_", tol=0.0)
    stages += inner
    stages.append({f"{prefix}x_{i}": " + ".join(f"{prefix}a0_{i}_{j} * {prefix}m_{j} * {found[0][j]}" for j in range(n)) for i in range(n)})
    return stages, [f"{prefix}x_{i}" for i in range(n)]


def apply_stages(df: DataFrame, stages: Sequence[dict[str, str]]) -> DataFrame:
    """Add the stage columns to ``df`` layer by layer."""
    for layer in stages:
        df = df.withColumns({name: F.expr(sql) for name, sql in layer.items()})
    return df


def stages_as_ctes(source: str, stages: Sequence[dict[str, str]], prefix: str) -> tuple[str, str]:
    """Render ``stages`` as chained CTEs over relation ``source``.

    Returns ``(cte_text, last_relation)``; used for SQL checks of the solve.
    """
    parts = []
    prev = source
    for idx, layer in enumerate(stages):
        name = f"{prefix}s{idx}"
        cols = ", ".join(f"{sql} AS {col}" for col, sql in layer.items())
        parts.append(f"{name} AS (SELECT *, {cols} FROM {prev})")
        prev = name
    return ",\n".join(parts), prev
