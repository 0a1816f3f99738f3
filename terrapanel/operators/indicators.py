"""Wide indicator tables: present-count filter, k-nearest-neighbour gap filling, reshape.

A wide indicator table has id columns (country name/code, indicator
name/code) and one numeric column per year.  Gap filling follows the
nearest-neighbour imputer of the study: rows are entities, the year columns
are features; for a row missing year t the donors are the rows that have t,
at the NaN-aware Euclidean distance

    d(a, b) = sqrt(T / |S| * sum_{s in S} (a_s - b_s)^2),  S = years both have,

T the number of year columns.  The gap gets the mean of the k nearest donors
with a defined distance (ties broken by entity code), or the year's mean when
no donor has one.  The donor search is pruned by equi-depth value buckets (see
:func:`knn_fill`); distances of candidate pairs are array expressions, donors
are ranked per missing cell.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.session import cut_lineage

PERIOD = "_period"
VALUE = "_value"


def min_present(df: DataFrame, k: int) -> DataFrame:
    """Keep rows with at least ``k`` present (non-null, non-NaN) cells over all columns."""
    return df.dropna(thresh=k)


def value_columns(df: DataFrame, ids: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in ids]


def to_cells(wide: DataFrame, ids: Sequence[str], value_cols: Sequence[str] | None = None) -> DataFrame:
    """All cells of the wide table, gaps included: ids..., _period (int), _value."""
    value_cols = list(value_cols or value_columns(wide, ids))
    cells = wide.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in value_cols])
    cells = cells.unpivot(list(ids), value_cols, PERIOD, VALUE)
    return cells.withColumn(PERIOD, F.col(PERIOD).try_cast("int")).withColumn(
        VALUE, F.when(~F.isnan(VALUE), F.col(VALUE)))


def wide_to_long(wide: DataFrame, ids: Sequence[str], value_name: str,
                 period_name: str = "Year", value_cols: Sequence[str] | None = None) -> DataFrame:
    """Stack the year columns into rows; empty cells are skipped."""
    cells = to_cells(wide, ids, value_cols)
    return cells.where(F.col(VALUE).isNotNull()).select(
        *ids, F.col(PERIOD).alias(period_name), F.col(VALUE).alias(value_name))


def pair_distances(cells: DataFrame, entity: str, n_features: int,
                   receivers: DataFrame | None = None) -> DataFrame:
    """NaN-aware distances between entities: a, b, n_shared, distance (a != b).

    ``receivers`` (a one-column DataFrame of entity codes) limits the left
    side to entities that actually have a gap.  Pairs with no shared year get
    no row (their distance is undefined).
    """
    present = cells.where(F.col(VALUE).isNotNull())
    left = present.select(F.col(entity).alias("a"), PERIOD, F.col(VALUE).alias("va"))
    if receivers is not None:
        left = left.join(receivers.select(F.col(entity).alias("a")), "a", "left_semi")
    right = present.select(F.col(entity).alias("b"), PERIOD, F.col(VALUE).alias("vb"))
    pairs = left.join(right, PERIOD).where(F.col("a") != F.col("b"))
    return pairs.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n_shared"),
        F.sum(F.pow(F.col("va") - F.col("vb"), 2)).alias("_ss"),
    ).select("a", "b", "n_shared",
             F.sqrt(F.lit(float(n_features)) / F.col("n_shared") * F.col("_ss")).alias("distance"))


#: Donors of a value bucket, growth of the window of buckets a level, buckets a year at most.
BUCKET, GROWTH, MAX_BUCKETS = 32, 4, 1024
#: Years whose presence patterns decide how many pivots a receiver needs: at most 2 ** 12 patterns.
PATTERN_YEARS = 12


def _vectors(cells: DataFrame, entity: str) -> tuple[DataFrame, list]:
    """One row an entity: ``e``, ``vec`` (its values in the order of the years, null for a gap); and the years."""
    years = [r[0] for r in cells.select(PERIOD).distinct().orderBy(PERIOD).collect()]  # the time axis
    one = cells.groupBy(entity, PERIOD).agg(F.max(VALUE).alias(VALUE))
    by_year = one.groupBy(F.col(entity).alias("e")).agg(F.map_from_entries(F.collect_list(F.struct(PERIOD, VALUE))).alias("m"))
    vec = F.array(*[F.element_at("m", F.lit(y)) for y in years]).cast("array<double>")
    return cut_lineage(by_year.select("e", vec.alias("vec"))), years


def _pivot_counts(vectors: DataFrame, order: list[int]) -> dict[int, int]:
    """For each pattern of present top years: the number of its years, in order, that reach every donor.

    A donor that lacks all pivots so far would need one more.  Where the top years don't reach all
    donors, every present year is a pivot (a donor that lacks all of these is not comparable).
    """
    top = order[:PATTERN_YEARS]
    patterns = {r[0] for r in vectors.select(_pattern(top).alias("p")).distinct().collect()}  # at most 2 ** PATTERN_YEARS
    donors = np.array(sorted(patterns))
    out = {}
    for mask in patterns:
        own = [k for k in range(len(top)) if mask >> k & 1]
        lacking, out[mask] = donors, len(order)
        for r, k in enumerate(own, 1):
            lacking = lacking[(lacking >> k & 1) == 0]
            if not len(lacking):
                out[mask] = r
                break
    return out


def _pattern(top: list[int]) -> Column:
    bits = [F.when(F.col("vec")[i].isNotNull(), 1 << k).otherwise(0) for k, i in enumerate(top)]
    return sum(bits, F.lit(0)).cast("int")


def _bucket(value: Column, bounds: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, by steps of 32 and then of one."""
    steps = F.filter(bounds, lambda x, i: (i % 32 == 0) & (x <= value))
    block = F.greatest(F.size(steps) - 1, F.lit(0)) * 32
    return block + F.size(F.filter(F.slice(bounds, block + 1, F.lit(32)), lambda x: x <= value))


def _distance(n_features: int) -> Column:
    """NaN-aware distance of the arrays va and vb."""
    squares = F.filter(F.zip_with("va", "vb", lambda x, y: (x - y) * (x - y)), lambda x: x.isNotNull())
    total = F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.lit(float(n_features)) / F.size(squares) * total)


def candidate_donors(vectors: DataFrame, open_cells: DataFrame, pivots: DataFrame, donors: DataFrame, half: int, buckets: int) -> DataFrame:
    """a, va, w, b: donors whose value lies in a window of ``half`` buckets each side of the receiver's, on a pivot year.

    A donor is met by the first pivot that it has.  Every donor that is not met is farther than ``w``.
    """
    inf = F.lit(math.inf)
    near = pivots.join(open_cells.select("a").distinct(), "a", "left_semi")
    low, high = F.col("bucket") - half, F.col("bucket") + half + 1
    gap = F.least(F.when(low >= 1, F.col("value") - F.get("bounds", low - 1)).otherwise(inf),
                  F.when(high <= buckets - 1, F.get("bounds", high - 1) - F.col("value")).otherwise(inf))
    near = near.withColumn("gap", gap).withColumn("w", F.min("gap").over(Window.partitionBy("a")))
    probes = near.select("a", "w", "year", "earlier", F.explode(
        F.sequence(F.greatest(low, F.lit(0)), F.least(high - 1, F.lit(buckets - 1)))).alias("bucket"))
    met = probes.join(donors, ["year", "bucket"]).where(
        (F.col("a") != F.col("b")) & F.forall("earlier", lambda y: F.get("present", y) == 0))
    whole = vectors.select(F.col("e").alias("a"), F.col("vec").alias("va"))
    return met.select("a", "w", "b").join(whole, "a")


def knn_fill(cells: DataFrame, entity: str, n_features: int, k: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Fill for every missing cell: entity, _period, imputed, n_donors (0 = year mean used).

    Exact k-nearest-neighbour search without comparing every receiver with
    every donor.  For any year s both rows have, d(a, b) >= |a_s - b_s|
    (the scale T/|S| is at least 1).  Each year's values are cut into equi-depth buckets of about
    ``bucket`` donors, so dense and sparse values cost the same.  A receiver looks at a window of buckets around its
    own value in each of its pivot years, those with the most donors first, and as many as reach every
    donor; on the r-th pivot only donors that lack the earlier ones count.  Whoever is outside the
    windows is farther than the receiver's distance to their nearest edge, so once the k-th
    best candidate is within that, the cell is settled; otherwise the window grows GROWTH times.  The
    last window holds everyone.  Each level's results are checkpointed.
    """
    vectors, years = _vectors(cells, entity)
    position = F.create_map(*[F.lit(x) for i, y in enumerate(years) for x in (y, i)]) if years else F.lit(None)
    missing = cells.where(F.col(VALUE).isNull()).select(F.col(entity).alias("a"), PERIOD, position[F.col(PERIOD)].alias("at"))
    n = range(len(years))
    stats = vectors.agg(*[F.count(F.col("vec")[i]).alias(f"n{i}") for i in n], *[F.avg(F.col("vec")[i]).alias(f"m{i}") for i in n], F.count("*").alias("n")).first()
    buckets = max(1, min(MAX_BUCKETS, max([stats[f"n{i}"] for i in n], default=0) // bucket))
    order = sorted(n, key=lambda i: (-stats[f"n{i}"], i))
    shares = [j / buckets for j in range(1, buckets)]
    bounds = [[]] * len(years)
    if shares:
        bounds = vectors.agg(*[F.percentile_approx(F.col("vec")[i], shares, 20 * MAX_BUCKETS).alias(f"q{i}") for i in n]).first()
    spark = cells.sparkSession
    # A row a year: at most MAX_BUCKETS numbers each.
    bounds = F.broadcast(spark.createDataFrame([(i, list(bounds[i] or [])) for i in n], "year int, bounds array<double>"))

    counts = _pivot_counts(vectors, order)
    needed = F.broadcast(spark.createDataFrame(list(counts.items()), "pattern int, needed int"))
    receivers = vectors.join(missing.select(F.col("a").alias("e")).distinct(), "e", "left_semi").withColumn("pattern", _pattern(order[:PATTERN_YEARS]))
    ordered = F.array(*[F.lit(i) for i in order]).cast("array<int>")
    # Without a row for the pattern (none can lack one) all present years would be pivots.
    chosen = F.slice(F.filter(ordered, lambda i: F.get("vec", i).isNotNull()), F.lit(1), F.coalesce("needed", F.lit(len(order))))
    pivots = receivers.join(needed, "pattern", "left").select(F.col("e").alias("a"), "vec", chosen.alias("chosen"))
    pivots = pivots.select("a", "vec", "chosen", F.posexplode("chosen").alias("r", "year")).join(bounds, "year")
    pivots = cut_lineage(pivots.withColumn("value", F.get("vec", F.col("year"))).select(
        "a", "year", "bounds", "value", F.slice("chosen", F.lit(1), F.col("r")).alias("earlier"), _bucket(F.col("value"), F.col("bounds")).alias("bucket")))
    used = pivots.select("year").distinct()
    present = F.transform("vec", lambda x: F.when(x.isNull(), 0).otherwise(1).cast("byte"))
    donors = vectors.select(F.col("e").alias("b"), present.alias("present"), F.posexplode("vec").alias("year", "value")).where(F.col("value").isNotNull())
    donors = donors.join(F.broadcast(bounds), "year").join(used, "year", "left_semi")
    donors = cut_lineage(donors.select("b", "present", "year", _bucket(F.col("value"), F.col("bounds")).alias("bucket")))

    other = vectors.select(F.col("e").alias("b"), F.col("vec").alias("vb"))
    open_cells, settled, half = missing, [], 1
    while True:
        cand = candidate_donors(vectors, open_cells, pivots, donors, half, buckets).join(other, "b")
        cand = cand.withColumn("distance", _distance(n_features)).join(open_cells, "a")
        cand = cand.select("a", PERIOD, "w", "distance", "b", F.get("vb", F.col("at")).alias("v")).where(F.col("v").isNotNull())
        rank = F.row_number().over(Window.partitionBy("a", PERIOD).orderBy("distance", "b"))
        best = cand.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("a", PERIOD).agg(
            F.avg("v").alias("_knn"), F.count(F.lit(1)).alias("n_donors"), F.max("distance").alias("_kth"), F.first("w").alias("w"))
        last = half >= buckets
        done = best if last else best.where((F.col("n_donors") == k) & (F.col("_kth") <= F.col("w") * (1.0 - 1e-9)))
        settled.append(cut_lineage(done.select("a", PERIOD, "_knn", "n_donors")))
        if last:
            break
        open_cells = cut_lineage(open_cells.join(settled[-1].select("a", PERIOD), ["a", PERIOD], "left_anti"))
        if open_cells.isEmpty():
            break
        half *= GROWTH
    nearest = settled[0]
    for more in settled[1:]:
        nearest = nearest.unionByName(more)
    mean = F.element_at(F.create_map(*[F.lit(x) for i, y in enumerate(years) for x in (y, stats[f"m{i}"])]), F.col(PERIOD)) if years else F.lit(None)
    return missing.join(nearest, ["a", PERIOD], "left").select(
        F.col("a").alias(entity), PERIOD, F.coalesce("_knn", mean.cast("double")).alias("imputed"),
        F.coalesce("n_donors", F.lit(0)).alias("n_donors"))


def knn_impute(wide: DataFrame, ids: Sequence[str], entity: str, k: int = 2,
               value_cols: Sequence[str] | None = None) -> DataFrame:
    """The wide table with every gap replaced by its k-nearest-neighbour fill."""
    value_cols = list(value_cols or value_columns(wide, ids))
    cells = to_cells(wide, ids, value_cols)
    fill = knn_fill(cells, entity, len(value_cols), k)
    filled = cells.join(fill.select(entity, PERIOD, "imputed"), [entity, PERIOD], "left").withColumn(
        VALUE, F.coalesce(VALUE, "imputed"))
    years = [int(c) for c in value_cols]
    out = filled.groupBy(*ids).pivot(PERIOD, years).agg(F.first(VALUE))
    return out.select(*ids, *[F.col(str(y)).alias(c) for y, c in zip(years, value_cols)])


def clean_indicator(wide: DataFrame, ids: Sequence[str], entity: str, value_name: str,
                    min_cells: int, k: int = 2, drop: Sequence[str] = ()) -> DataFrame:
    """Indicator cleaning end to end: present-count filter, KNN fill, long layout."""
    kept = min_present(wide, min_cells)
    filled = knn_impute(kept, ids, entity, k)
    keep_ids = [c for c in ids if c not in drop]
    return wide_to_long(filled.drop(*drop), keep_ids, value_name)
