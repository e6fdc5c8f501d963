"""Connected components of a graph given as edges, by alternating large and small stars.

Every round is a map-side combined minimum per node and one join with the edges, so a
node with very many neighbours is one row on one side of a join whose other side
Spark splits. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (large star) or smaller (small star) neighbours to the smallest one, itself included."""
    if large:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of all nodes that have an edge. ``edges`` has whole-number columns u and v.

    Rounds go on until a round changes nothing; their number grows with the logarithm of the nodes."""
    clean = lambda e: e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v")).distinct()
    edges = written(clean(edges), "star")
    seen = None
    while True:
        edges = written(clean(_star(clean(_star(edges, True)), False)), "star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
