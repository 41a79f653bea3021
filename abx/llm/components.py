"""Connected components by local contraction (Łącki, Mirrokni and Włodarczyk, 2018).

Each round gives every node a random rank, merges it into the lowest-ranked node
of its closed neighbourhood and relabels the edges; the graph shrinks by a
constant factor in expectation, whatever its shape, so rounds grow with the
logarithm of the edge count. Edges and maps stay distributed: hubs are reduced
by aggregation before the shuffle, and joins have one row per node on one side,
which leaves hot nodes to Spark's skew-join splitting. Each round ends in a
written table in the shared folder.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abx.llm.runtime import written


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (a group's first place for each place) with the groups of each pair of
    places merged. For use within a task, on the pairs it has just found."""
    x, y = label[i], label[j]
    open_ = x != y
    if not open_.any():
        return label
    parent: dict[int, int] = {}

    def root(k: int) -> int:
        while parent.get(k, k) != k:
            k = parent[k]
        return k

    for p, q in np.unique(np.stack((x[open_], y[open_]), axis=1), axis=0).tolist():
        p, q = root(p), root(q)
        if p != q:
            parent[max(p, q)] = min(p, q)
    to = np.arange(len(label))
    for k in parent:
        to[k] = root(k)
    return to[label]


def _ordered(a: Column, b: Column) -> DataFrame:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for each node of ``edges``; a component is named by its
    smallest node. Any ordered type will do. Nulls, loops and repeated edges are
    ignored; no edges give an empty result."""
    x, y = F.col(a), F.col(b)
    left = written(edges.where(x != y).select(*_ordered(x, y)).distinct(), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        salt = F.lit(len(maps))

        def ranked(node: Column, salt=salt) -> Column:
            return F.struct(F.xxhash64(node, salt).alias("h"), node.alias("v"))

        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            left.select(F.col("b").alias("node"), F.col("a").alias("other")))
        best = both.groupBy("node").agg(F.min(ranked(F.col("other"))).alias("best"))
        to = written(best.select("node", F.least(F.col("best"), ranked(F.col("node")))["v"].alias("to")), "map")
        maps.append(to)
        moved = (left.join(to.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
                 .join(to.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b"))
        left = written(moved.where(F.col("ta") != F.col("tb")).select(*_ordered(F.col("ta"), F.col("tb"))).distinct(),
                       "edges")
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = maps[-1]
    for to in reversed(maps[:-1]):
        later = roots.select(F.col("node").alias("to"), F.col("to").alias("root"))
        roots = to.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("to"))
    roots = written(roots, "roots")
    least = roots.groupBy("to").agg(F.min("node").alias("component"))
    return roots.join(least, "to").select("node", "component")
