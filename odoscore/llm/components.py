"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def spanning_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of one task, replaced by one edge from each node to the smallest node of its component."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        joined = label.copy()
        np.minimum.at(joined, label[x], low)
        np.minimum.at(joined, label[y], low)
        while not np.array_equal(joined, joined[joined]):
            joined = joined[joined]
        if np.array_equal(joined, label):
            break
        label = joined
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    below = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs -> (node, root), where root is the smallest node of the component.

    Nodes without an edge to another node do not appear.  Each round is written to the shared folder; the
    rounds grow with the logarithm of the longest path.  A node with very many edges is summed up on the map
    side, and its rows in a join are split by the adaptive skew join.
    """
    swapped = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, seen = stored(swapped.distinct()), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        edges = stored(_small_star(_large_star(edges)))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
