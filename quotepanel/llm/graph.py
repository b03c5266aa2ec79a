"""Connected components by alternating stars; every round is a written table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quotepanel.session import stored


def _state(edges: DataFrame) -> tuple:
    sums = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    return tuple(sums.first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.filter("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours point to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    moved = down.join(least, F.col("a") == F.col("node")).filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (a, b) with the least node it is connected to."""
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and edges (a, b) the least node each is connected to."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
    return root
