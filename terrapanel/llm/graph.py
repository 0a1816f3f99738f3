"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapanel.llm.common import materialise


def _mark(edges: DataFrame) -> tuple:
    """Changes if the edge set does; one row to the driver."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that ``links`` (a, b) mentions.

    Each step hangs the neighbours of a node on the smallest of them, first the larger ones,
    then the smaller ones, until every component is one star.  Edges never grow in number, each step
    is written to the shared folder, and a node with very many neighbours is pre-aggregated.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = materialise(edges)
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialise(low.select("u", F.col("m").alias("v")).unionByName(small).distinct())
        now = _mark(stars)
        edges = stars
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
