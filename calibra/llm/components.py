"""Connected components by alternating star contraction.

Edges always point from the larger to the smaller node.  A round hangs every child under the
parent of its parent (large star) and all parents of a child under the smallest of them (small
star).  Only nodes that are still children travel as lookup rows, so the root of a giant
component is a key on the edge side alone, where adaptive execution splits it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import store


def _parents(edges: DataFrame) -> DataFrame:
    found = edges.groupBy("child").agg(F.min("parent").alias("least"), F.count(F.lit(1)).alias("n"))
    return store(found, "parents")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge that is not the smallest of its component.

    ``component`` is the smallest node reachable.  Loops, repeated edges and edges with a missing
    end are ignored; a node that is absent from the result is its own component.  Ends when the
    edges form stars, after a number of rounds that grows with the logarithm of the longest path.
    """
    pairs = edges.where(F.col(a) != F.col(b))
    edges = store(
        pairs.select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent")).distinct(), "edges"
    )
    while True:
        parents = _parents(edges)
        several = parents.where("n > 1").limit(1).count()
        chained = edges.join(parents, edges["parent"] == parents["child"], "left_semi").limit(1).count()
        if not several and not chained:
            return parents.select(F.col("child").alias("node"), F.col("least").alias("component"))
        up = parents.select(F.col("child").alias("parent"), "least")
        large = store(
            edges.join(up, "parent", "left")
            .select("child", F.coalesce("least", "parent").alias("parent"))
            .distinct(),
            "large-star",
        )
        least = _parents(large).select("child", "least")
        met = large.join(least, "child")
        both = F.explode(
            F.array(
                F.struct(F.col("child"), F.col("least").alias("parent")),
                F.struct(F.col("parent").alias("child"), F.col("least").alias("parent")),
            )
        )
        edges = store(met.select(both.alias("e")).select("e.*").where("child != parent").distinct(), "small-star")
