"""Moments and z-scores as aggregates (partial + final, never a row collection)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mean_col(c: str) -> str:
    return f"mean_{c}"


def sd_col(c: str) -> str:
    return f"sd_{c}"


def cov_col(a: str, b: str) -> str:
    return f"cov_{a}__{b}"


def moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (),
            cross: bool = True) -> DataFrame:
    """Count, mean, population sd (ddof 0) and pairwise population covariances.

    One aggregate per group, map-side combined: a group holding a third of
    all rows still reaches the final aggregate as one partial row per task.
    With no ``by`` the result is a single row.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("n")]
    for c in cols:
        aggs += [F.avg(c).alias(mean_col(c)), F.stddev_pop(c).alias(sd_col(c))]
    if cross:
        for a, b in combinations(cols, 2):
            aggs.append(F.covar_pop(a, b).alias(cov_col(a, b)))
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(*aggs)


def corr_sql(a: str, b: str, cols: Sequence[str]) -> str:
    """SQL for the correlation of ``a`` and ``b`` on a :func:`moments` row (NULL if an sd is 0)."""
    sa, sb = sd_col(a), sd_col(b)
    if a == b:
        return f"CASE WHEN {sa} > 0 THEN CAST(1 AS DOUBLE) END"
    ia, ib = cols.index(a), cols.index(b)
    cov = cov_col(a, b) if ia < ib else cov_col(b, a)
    return f"CASE WHEN {sa} > 0 AND {sb} > 0 THEN {cov} / ({sa} * {sb}) END"


def _z(value: Column, mean: Column, sd: Column) -> Column:
    return F.when(sd > 0, (value - mean) / sd)


def zscore_by(df: DataFrame, cols: Sequence[str], by: Sequence[str],
              prefix: str = "z_") -> DataFrame:
    """Add ``z_<col>`` standardised within each ``by`` group (ddof 0; NULL when sd is 0).

    Group moments (one row per group) are joined back on the group key, so a
    large group is never gathered into one task as a window would.
    """
    m = moments(df, cols, by, cross=False)
    out = df.join(m, list(by))
    out = out.withColumns({
        f"{prefix}{c}": _z(F.col(c), F.col(mean_col(c)), F.col(sd_col(c))) for c in cols
    })
    return out.drop("n", *[mean_col(c) for c in cols], *[sd_col(c) for c in cols])


def zscore_global(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Add ``z_<col>`` standardised over the whole table (ddof 0).

    The means and sds enter as scalar subqueries, which Spark merges into a
    single aggregate job and inlines as constants: no join, no shuffle of
    the rows.
    """
    out = {}
    for c in cols:
        mean = df.select(F.avg(c)).scalar()
        sd = df.select(F.stddev_pop(c)).scalar()
        out[f"{prefix}{c}"] = _z(F.col(c), mean, sd)
    return df.withColumns(out)
