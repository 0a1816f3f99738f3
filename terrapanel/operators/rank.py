"""Group averages, rankings and set-membership filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_average(df: DataFrame, by: str, value: str, alias: str,
                  cast: str | None = "float") -> DataFrame:
    """Average of ``value`` per ``by``; ``cast`` reproduces the 32-bit cast before averaging."""
    col = F.col(value).cast(cast) if cast else F.col(value)
    return df.groupBy(by).agg(F.avg(col).alias(alias))


def _order(col: str, tie: Sequence[str], ascending: bool) -> list:
    first = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return [first] + [F.col(t).asc() for t in tie]


def top_k(df: DataFrame, col: str, k: int, tie: Sequence[str] = (),
          ascending: bool = False) -> DataFrame:
    """The ``k`` rows with the largest (or smallest) ``col``; ``tie`` breaks ties.

    Planned as TakeOrderedAndProject: each partition keeps its own top k, so
    no full sort or single-partition window is needed.
    """
    return df.orderBy(*_order(col, tie, ascending)).limit(k)


def bottom_k(df: DataFrame, col: str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    return top_k(df, col, k, tie, ascending=True)


def position_slice(df: DataFrame, col: str, start: int, stop: int,
                   tie: Sequence[str] = (), ascending: bool = True) -> DataFrame:
    """Rows at positions ``start`` .. ``stop - 1`` of the ordering (0-based)."""
    return df.orderBy(*_order(col, tie, ascending)).offset(start).limit(stop - start)


def members_of(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``members`` (a left-semi join)."""
    return df.join(members.select(key), key, "left_semi")
