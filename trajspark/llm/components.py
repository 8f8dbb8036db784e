"""Connected components by alternating large and small stars.

Every round keeps at most the edges it got, takes minima with partial aggregation and joins them
back, so a node with very many links is neither gathered in one place nor expanded into pairs.
"""

import numpy as np
from pyspark.sql import DataFrame, functions as F

from trajspark.llm.common import cut


def _edges(frame, a, b):
    return frame.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(
        F.col("a") != F.col("b")).distinct()


def _large_star(edges):
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    joined = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return _edges(joined, "b", "m")


def _small_star(edges):
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    return _edges(joined.select("b", "m").union(least.select("a", "m")), "b", "m")


def _digest(edges):
    row = edges.agg(F.count("*").alias("n"), F.sum(
        F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s")).first()
    return row.n, row.s


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links between long nodes -> (node, root), root being the smallest node reachable.

    Nodes that are their own root, and so nodes without links, are not listed. Links of a node
    with itself, repeated links and links with nulls change nothing; no links give no rows.
    """
    edges = cut(_edges(edges.filter("a is not null and b is not null"), F.col("a"), F.col("b")))
    seen = _digest(edges)
    while seen[0]:
        edges = cut(_small_star(_large_star(edges)))
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def merged(label, i, j):
    """Labels of one tile pair after links i[k] - j[k]; a label is the smallest index reachable."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter
    return label
