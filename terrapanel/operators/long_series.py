"""Positions and lags of series of any length, without one window task a series.

Rows are range-sorted once by (series, order) and written with their range and their place in it; the
position of a row is its place there plus the rows of its series in the ranges before, known from one count a
(range, series).  Lags look back inside fixed blocks of positions that carry the last rows of the block before (the halo).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.session import cut_lineage

POSITION = "position"
BLOCK = 100_000
#: Bits of monotonically_increasing_id below the partition number.
_ROW_BITS = 33


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``position``, from 0 in each series (``keys``) by ``order``; nulls come first and form a series of their own.

    ``order`` should tell the rows of a series apart: rows that tie stay together in one range and are
    numbered in any order.  The range-sorted rows are materialised, so ranges can't be drawn twice.
    """
    keys = list(keys)
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    row = F.monotonically_increasing_id()
    ranged = cut_lineage(ranged.withColumns({
        "_range": F.shiftright(row, _ROW_BITS), "_place": row.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))}))
    # One row a (range, series): of a series with many ranges few, of a range with many series as many as it has.
    counts = ranged.groupBy("_range", *keys).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(
        F.col("_range").alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    on = [ranged["_range"] == shift["_r"]] + [ranged[k].eqNullSafe(shift[f"_k{i}"]) for i, k in enumerate(keys)]
    return ranged.join(shift, on).select(*[ranged[c] for c in df.columns], (F.col("_place") + F.col("_shift")).alias(POSITION))


def split_by_share(
    numbered: DataFrame, keys: Sequence[str], percent: int, position: str = POSITION, block: int = BLOCK,
) -> DataFrame:
    """``split``: 'train' for the first ``percent`` hundredths of each series (whole rows, rounded down), else 'test'.

    The size of a series goes to its rows by blocks of positions, so a task reads blocks and never a whole series.
    """
    keys = list(keys)
    dealt = numbered.withColumn("_block", F.floor(F.col(position) / block))
    sizes = dealt.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    # One row a (series, block).
    total = F.sum("_n").over(Window.partitionBy(*keys))
    sizes = sizes.select(F.col("_block").alias("_b"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                         F.floor(total * percent / 100).alias("_cut"))
    on = [dealt["_block"] == sizes["_b"]] + [dealt[k].eqNullSafe(sizes[f"_k{i}"]) for i, k in enumerate(keys)]
    split = F.when(F.col(position) < F.col("_cut"), "train").otherwise("test")
    return dealt.join(sizes, on).select(*[dealt[c] for c in numbered.columns], split.alias("split"))


def lags(
    numbered: DataFrame, keys: Sequence[str], value: str, steps: Sequence[int], position: str = POSITION, block: int = BLOCK,
) -> DataFrame:
    """``lag_k`` for each k of ``steps``: the value exactly k positions earlier, null where that position is missing.

    ``position`` is any whole number that is unique in its series (gaps are allowed, so a month number will do).
    A task holds at most ``block`` rows and the halo, whatever the length of the series.
    """
    keys, reach = list(keys), max(steps)
    if min(steps) < 1 or block < reach:
        raise ValueError(f"steps must lie in 1 to block ({block}), not {list(steps)}")
    home = F.floor(F.col(position) / block)
    in_halo = F.col(position) >= (home + 1) * block - reach
    dealt = numbered.select(
        "*", F.explode(F.when(in_halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_ahead"))
    dealt = dealt.withColumn("_block", home + F.col("_ahead"))
    back = Window.partitionBy(*keys, "_block").orderBy(position)
    found = {f"lag_{k}": F.max(value).over(back.rangeBetween(-k, -k)) for k in steps}
    return dealt.withColumns(found).where(F.col("_ahead") == 0).drop("_ahead", "_block")
