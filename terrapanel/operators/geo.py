"""Coordinates -> country: exact nearest-place join and code lookup.

Points and places become unit vectors.  Places are held in an adaptive tree of
cubes: only occupied cubes exist, dense ones are split until few places are left in
each, and each has the spherical cap that holds its places.  A point descends
from the root by equi-joins and drops every cube whose cap begins beyond the best
distance known so far (branch and bound), so it meets only the places of
the last few cubes, whether it lies in a dense town or on the other side of the globe.  The
answer is always exact; ties go to the smaller place id.

The tree and each round's state are written to the shared checkpoint folder: plans stay
short, and a lost executor resumes from the last finished round.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.session import cut_lineage

EARTH_RADIUS_KM = 6371.0
#: Places that a cube may hold without being split.
LEAF_PLACES = 8
#: Halvings of the cube around the sphere, and how many of them one step of the tree takes.
DEPTH, STEP = 18, 2
_AXES = ("_x", "_y", "_z")
_PLACE = ("_gx", "_gy", "_gz")
_CENTRE = ("_mx", "_my", "_mz")
_ONE = ("_ox", "_oy", "_oz")


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return [F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)]


def _with_xyz(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.withColumns(dict(zip(_AXES, unit_vector(F.col(lat), F.col(lon)))))


def chord(ax: str = "_x", ay: str = "_y", az: str = "_z",
          bx: str = "_gx", by: str = "_gy", bz: str = "_gz") -> Column:
    return F.sqrt(F.pow(F.col(ax) - F.col(bx), 2) + F.pow(F.col(ay) - F.col(by), 2)
                  + F.pow(F.col(az) - F.col(bz), 2))


def chord_to_km(c: Column) -> Column:
    return 2.0 * EARTH_RADIUS_KM * F.asin(F.least(c / 2.0, F.lit(1.0)))


def angle(a: Sequence[str] = _AXES, b: Sequence[str] = ("_gx", "_gy", "_gz")) -> Column:
    """Angle between two unit vectors, accurate for near and for opposite ones."""
    (ax, ay, az), (bx, by, bz) = ([F.col(c) for c in v] for v in (a, b))
    across = F.sqrt(F.pow(ay * bz - az * by, 2) + F.pow(az * bx - ax * bz, 2) + F.pow(ax * by - ay * bx, 2))
    return F.atan2(across, ax * bx + ay * by + az * bz)


def _distinct_places(places: DataFrame) -> DataFrame:
    """One place a position, the one with the smallest id: a position holding a third of all costs one row."""
    one = places.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy("latitude", "longitude").agg(
        F.min(F.struct("place_id", "cc")).alias("_p"))
    one = _with_xyz(one.select("latitude", "longitude", "_p.place_id", "_p.cc"))
    return one.select("place_id", "cc", *[F.col(a).alias(g) for a, g in zip(_AXES, _PLACE)])


def cell_tree(gaz: DataFrame, leaf_places: int = LEAF_PLACES) -> tuple[DataFrame, DataFrame]:
    """An adaptive tree of cubes over places (place_id, cc, _gx, _gy, _gz): ``(nodes, places)``, both written.

    A cube with more than ``leaf_places`` places is split, down to DEPTH halvings (a few dozen metres); a cube
    whose places all lie in one smaller cube is left out, so a dense town is few steps below the
    root.  ``nodes``: node, parent, leaf, the cap that holds its places (centre, radius as an angle) and one
    of them.  ``places`` has the leaf of each place as ``node``.
    """
    top = 2**DEPTH
    fine = [F.least(F.floor((F.col(g) + 1.0) / 2.0 * top), F.lit(top - 1)) for g in _PLACE]

    def cube(depth: int) -> Column:
        key = F.lit(depth).cast("long")
        for c in fine:  # the depth, then the three indices: one number names a cube
            key = F.shiftleft(key, DEPTH).bitwiseOR(F.shiftright(c, DEPTH - depth))
        return F.struct(F.lit(depth).alias("depth"), key.alias("node"))

    steps = range(0, DEPTH + 1, STEP)
    rows = gaz.withColumn("c", F.explode(F.array(*[cube(d) for d in steps]))).select(*gaz.columns, "c.depth", "c.node")
    counts = rows.groupBy("node").agg(F.count("*").alias("n"))
    chain = rows.join(counts, "node").groupBy(*gaz.columns).agg(F.array_sort(F.collect_list(F.struct("depth", "n", "node"))).alias("chain"))
    # The cubes that hold fewer places than the one above, down to the first that need not be split.
    chain = chain.withColumn("chain", F.filter("chain", lambda x, i: (i == 0) | (x["n"] < F.col("chain")[F.greatest(i - 1, F.lit(0))]["n"])))
    split = F.size(F.filter("chain", lambda x: x["n"] > leaf_places))
    path = F.transform(F.slice("chain", F.lit(1), F.least(split + 1, F.size("chain"))), lambda x: x["node"])
    placed = cut_lineage(chain.withColumn("path", path).drop("chain"))
    of_node = placed.select(*gaz.columns, F.posexplode("path").alias("at", "node"), F.size("path").alias("size"),
                            "path").withColumn("parent", F.when(F.col("at") > 0, F.col("path")[F.col("at") - 1])).drop("path")
    caps = of_node.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first(F.col("at") == F.col("size") - 1).alias("leaf"),
        *[F.avg(g).alias(c) for g, c in zip(_PLACE, _CENTRE)],
        F.min(F.struct("place_id", *_PLACE)).alias("one"))
    length = F.sqrt(sum((F.pow(F.col(c), 2) for c in _CENTRE), F.lit(0.0)))
    # Places all around the sphere may have no mean direction: any one of them is a centre then.
    caps = caps.withColumn("length", length).withColumns(
        {c: F.when(F.col("length") > 1e-6, F.col(c) / F.col("length")).otherwise(F.col(f"one.{g}")) for c, g in zip(_CENTRE, _PLACE)})
    reach = of_node.join(caps.select("node", *_CENTRE), "node").groupBy("node").agg(F.max(angle(_PLACE, _CENTRE)).alias("radius"))
    nodes = caps.join(reach, "node").select("node", "parent", "leaf", *_CENTRE, "radius", *[F.col(f"one.{g}").alias(c) for g, c in zip(_PLACE, _ONE)])
    return cut_lineage(nodes), placed.select("place_id", "cc", *_PLACE, F.element_at("path", -1).alias("node"))


def candidate_places(points: DataFrame, gaz: DataFrame, leaf_places: int = LEAF_PLACES) -> DataFrame:
    """latitude, longitude, place_id, cc, chord: of each point, the places that may be the nearest one.

    Branch and bound from the root: a point goes on to the children of its cubes; the nearest of the
    children's own sample places bounds the distance, and a cube whose cap begins beyond that bound is
    dropped.  A round is one equi-join on the parent and is written.
    """
    nodes, placed = cell_tree(gaz, leaf_places)
    point = ["latitude", "longitude", *_AXES]
    root = nodes.where("parent IS NULL").select("node", "leaf")
    state = points.crossJoin(F.broadcast(root)).select(  # the root is one row
        *point, "node", "leaf", F.lit(0.0).alias("least"), F.lit(math.inf).alias("bound"))
    below = nodes.where("parent IS NOT NULL").withColumnsRenamed({"node": "child", "leaf": "child_leaf"}).withColumnRenamed("parent", "node")
    while True:
        state = cut_lineage(state)
        if state.where("NOT leaf").isEmpty():
            break
        opened = state.where("NOT leaf").join(below, "node").select(
            *point, F.col("child").alias("node"), F.col("child_leaf").alias("leaf"),
            F.greatest(angle(_AXES, _CENTRE) - F.col("radius"), F.lit(0.0)).alias("least"),
            F.least("bound", angle(_AXES, _ONE)).alias("bound"))
        both = state.where("leaf").unionByName(opened)
        both = both.withColumn("bound", F.min("bound").over(Window.partitionBy("latitude", "longitude")))
        # The margin covers the rounding of angles.
        state = both.where(F.col("least") <= F.col("bound") * (1 + 1e-9) + 1e-12)
    return state.drop("leaf").join(placed, "node").select("latitude", "longitude", "place_id", "cc", chord().alias("chord"))


def nearest_place(points: DataFrame, places: DataFrame, leaf_places: int = LEAF_PLACES) -> DataFrame:
    """For each distinct (latitude, longitude) of ``points``: nearest place.

    ``places`` has place_id, latitude, longitude, cc.  Returns latitude,
    longitude, place_id, cc, chord, distance_km.  Without places no point has a nearest one.
    """
    pts = points.select("latitude", "longitude").where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).distinct()
    found = candidate_places(cut_lineage(_with_xyz(pts)), _distinct_places(places), leaf_places)
    best = found.groupBy("latitude", "longitude").agg(F.min(F.struct("chord", "place_id", "cc")).alias("_b"))
    return best.select("latitude", "longitude", "_b.place_id", "_b.cc", "_b.chord").withColumn(
        "distance_km", chord_to_km(F.col("chord")))


def country_codes(nearest: DataFrame, iso: DataFrame, missing: str = "NA") -> DataFrame:
    """Map the place's two-letter code to the three-letter code; unknown -> ``missing``."""
    return nearest.join(iso, nearest.cc == iso.alpha_2, "left").select(
        *[nearest[c] for c in nearest.columns],
        F.coalesce(iso.alpha_3, F.lit(missing)).alias("country_code"))


def geocode(points: DataFrame, places: DataFrame, iso: DataFrame) -> DataFrame:
    """Distinct coordinates of ``points`` with their country code (each resolved once)."""
    return country_codes(nearest_place(points, places), iso)
