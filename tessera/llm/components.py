"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in
    ``edges`` (``a, b`` of one ordered type; loops and repeats are harmless).

    Every round is written to the shared folder, so a lost executor costs at
    most one round.  A hub's minimum is pre-aggregated before its exchange and
    the joins are ones that adaptive execution can split.
    """
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .distinct(), "cc_edges")
    before = None
    while True:
        # large star: every larger neighbour of u moves to the smallest of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = materialize(large.where("u <> v"), "cc_large")
        # small star: u and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        e = materialize(small, "cc_small")
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def local_roots(n: int, pairs) -> "np.ndarray":  # noqa: F821
    """Component root (smallest index) of each of ``n`` local nodes; ``pairs``
    yields arrays ``(i, j)`` of linked indices, never kept together."""
    import numpy as np

    root = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = root[i], root[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return root
