"""Density clustering of few dimensions on a grid of cells.

Cells have the side ``eps / sqrt(d)``, so two points of one cell are always in reach of each other.

1. A cell that holds ``min_samples`` points is *dense*: all its points are core points, without a
   distance.  The points of the other cells, fewer than ``min_samples`` in each, ask the cells around theirs
   how many points they have in reach.  They travel to those cells; the points of a cell stay together.
2. Core points of one cell belong together, so clusters are components of cells.  The same way the
   points of sparse cells find the cells with a core point in reach.  Of a dense cell only its
   outermost points ask.
3. Two dense cells next to each other that are still in different components are compared in full:
   the points of each that are in reach of the other's box, in blocks.

A cell of any size is cut into blocks, and a cell is asked by a bounded number of points.
"""

from __future__ import annotations

import math
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.blocks import ROWS_PER_BLOCK, as_points, collapse, spread
from ..functions.ordering import with_position
from ..functions.sizing import TASK_ROWS, cut_lineage
from ..functions.vectors import matrix, sq_distances
from .density import _EDGE, NOISE, components
from .neighbors import _type

MAX_DIMS = 4
_PAIRS_AT_ONCE = 1_000_000


def offsets(dims: int) -> list[tuple[int, ...]]:
    """Cells that may hold a point in reach of a point of cell 0."""
    reach = 1 + math.isqrt(dims)
    return [o for o in product(range(-reach, reach + 1), repeat=dims) if sum(max(abs(v) - 1, 0) ** 2 for v in o) <= dims]


def _box_gap(x, cell, side: float, dims: int):
    """Squared distance of a point from the box of a cell."""
    return sum(
        F.pow(F.greatest(F.get(cell, F.lit(i)) * side - F.get(x, F.lit(i)), F.get(x, F.lit(i)) - (F.get(cell, F.lit(i)) + 1) * side, F.lit(0.0)), 2)
        for i in range(dims)
    )


def in_reach(left: pd.DataFrame, right: pd.DataFrame, limit: float):
    """Index pairs ``(i, j)`` of rows with one ``block`` whose squared distance is at most ``limit``, a part at a time."""
    names, code = np.unique(right["block"].to_numpy(), return_inverse=True)
    order = np.argsort(code, kind="stable")
    starts = np.searchsorted(code[order], np.arange(len(names) + 1))
    at = np.searchsorted(names, left["block"].to_numpy())
    known = np.flatnonzero((at < len(names)) & (names[np.minimum(at, len(names) - 1)] == left["block"].to_numpy()))
    at = at[known]
    sizes = starts[at + 1] - starts[at]
    a, b = matrix(left["x"]), matrix(right["x"])
    part = np.cumsum(sizes) // _PAIRS_AT_ONCE
    for rows in np.split(np.arange(len(known)), np.flatnonzero(np.diff(part)) + 1):
        n = sizes[rows]
        i = np.repeat(known[rows], n)
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        j = order[np.repeat(starts[at[rows]], n) + inside]
        near = ((a[i] - b[j]) ** 2).sum(axis=1) <= limit
        yield i[near], j[near]


def dbscan_grid(
    df: DataFrame, key: str, features: str, eps: float, min_samples: int,
    rows_per_block: int = ROWS_PER_BLOCK, task_rows: int = TASK_ROWS, max_dims: int = MAX_DIMS,
) -> DataFrame:
    """``(key, cluster)`` as :func:`density.dbscan` gives it, for points of at most ``max_dims`` dimensions.

    The work grows with the points and not with pairs of blocks.  More dimensions raise a ValueError:
    the number of neighbouring cells grows with five to their power, and ``dbscan`` fits better.
    """
    points = as_points(df, key, features)
    dims = points.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return points.select(key, F.lit(NOISE).alias("cluster"))
    if dims > max_dims:
        raise ValueError(f"{dims} dimensions, a grid takes {max_dims} at most")
    # A little less than the exact side: rounding must not put points out of reach into one cell.
    side, limit = eps / math.sqrt(dims) * (1 - 1e-9), eps * eps * (1 + _EDGE)
    cell = F.array(*[F.floor(F.get("x", F.lit(i)) / side).cast("bigint") for i in range(dims)])
    placed = cut_lineage(collapse(points, key).withColumn("cell", cell))
    extreme = [d for d in product((-1, 0, 1), repeat=dims) if any(d)]
    farthest = [F.max_by(F.struct("id", "x"), sum(F.get("x", F.lit(i)) * float(v) for i, v in enumerate(d) if v)) for d in extreme]
    cells = placed.groupBy("cell").agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.array_distinct(F.array(*farthest)).alias("outer")
    )
    cells = cells.select(
        F.monotonically_increasing_id().alias("c"), "cell", "n", "least", (F.col("w") >= min_samples).alias("dense"),
        F.when(F.col("w") >= min_samples, F.col("outer")).alias("outer"), F.ceil(F.col("n") / rows_per_block).cast("int").alias("subs"),
    )
    cells = cut_lineage(cells)
    slots = max(1, -(-placed.count() // rows_per_block))
    own = placed.join(cells.select("cell", "c", "dense", "subs"), "cell")
    own = cut_lineage(own.withColumn("sub", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int")).drop("subs"))

    def neighbours(some: DataFrame) -> DataFrame:
        """``(a, b, cell of b, blocks of b)`` for cells ``a`` and the cells around them, themselves included."""
        table = F.array(*[F.array(*[F.lit(v).cast("bigint") for v in o]) for o in offsets(dims)])
        around = some.select(F.col("c").alias("a"), F.col("cell").alias("__c"), F.explode(table).alias("o"))
        around = around.withColumn("cell", F.zip_with("__c", "o", lambda x, y: x + y)).drop("__c", "o")
        return around.join(cells.select("cell", F.col("c").alias("b"), "subs"), "cell")

    def ask(asking: DataFrame, answering: DataFrame, fn, schema: str) -> DataFrame:
        """Run ``fn(asking, answering)`` where points ``(a, id, x)`` meet the blocks of cells around theirs."""
        near = asking.join(neighbours(cells.join(asking.select(F.col("a").alias("c")).distinct(), "c")), "a")
        near = near.where(_box_gap(F.col("x"), F.col("cell"), side, dims) <= limit).drop("cell")
        near = near.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))).drop("subs")

        def slotted(frame, c):
            block = F.xxhash64(c, "sub")
            return frame.withColumn("block", block).withColumn("slot", F.pmod("block", F.lit(slots)).cast("int"))

        left, right = slotted(near, "b"), slotted(answering.withColumnRenamed("c", "b"), "b")
        left, right = (f.select(*[F.col(c).alias(c) for c in f.columns]) for f in (left, right))
        return left.groupBy("slot").cogroup(right.groupBy("slot")).applyInPandas(fn, schema)

    id_type = _type(points, key)

    def count(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found, w = np.zeros(len(left), dtype=np.int64), right["w"].to_numpy()
        if len(left) and len(right):
            for i, j in in_reach(left, right, limit):
                found += np.bincount(i, weights=w[j], minlength=len(left)).astype(np.int64)
        return pd.DataFrame({"id": left["id"], "n": found}).loc[found > 0]

    sparse = own.where("not dense")
    counts = ask(sparse.select(F.col("c").alias("a"), "id", "x"), own.select("c", "sub", "x", "w"), count, f"id {id_type}, n bigint")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n"))
    core = F.col("dense") | (F.coalesce("n", F.lit(0)) >= min_samples)
    flagged = cut_lineage(own.join(counts, "id", "left").select("id", "x", "c", "sub", "dense", core.alias("core")))

    def touch(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Each asking point with every cell that holds a core point in its reach."""
        hit = np.zeros(len(left), dtype=bool)
        if len(left) and len(right):
            for i, _ in in_reach(left, right, limit):
                hit[i] = True
        return left.loc[hit, ["a", "b", "id", "core"]]

    outer = cells.where("dense").select(F.col("c").alias("a"), F.explode("outer").alias("p"))
    outer = outer.select("a", "p.id", "p.x", F.lit(True).alias("core"))
    asking = flagged.where("not dense").select(F.col("c").alias("a"), "id", "x", "core").unionByName(outer)
    links = ask(asking, flagged.where("core").select("c", "sub", "x"), touch, f"a bigint, b bigint, id {id_type}, core boolean")
    links = cut_lineage(links.distinct())
    joined = links.where("core").select(F.lit(0).alias("config"), F.col("a").alias("u"), F.col("b").alias("v")).distinct()
    # A cell with core points is a node even where it stands alone.
    with_core = cut_lineage(flagged.where("core").groupBy("c").agg(F.min("id").alias("least")))
    alone = with_core.select(F.lit(0).alias("config"), F.col("c").alias("u"), F.col("c").alias("v"))
    joined = cut_lineage(joined.unionByName(alone))
    groups = cut_lineage(components(joined).select(F.col("node").alias("c"), "component"))

    open_ = _open_pairs(cells.where("dense"), neighbours, groups)
    if not open_.isEmpty():
        extra = _compare(open_, flagged.where("dense"), cells, side, dims, limit, rows_per_block)
        groups = components(joined.unionByName(extra)).select(F.col("node").alias("c"), "component")

    named = with_core.join(groups, "c")
    firsts = named.groupBy("component").agg(F.min("least").alias("first"))
    numbers = with_position(firsts, ["first"], name="cluster", task_rows=task_rows)
    named = cut_lineage(named.join(numbers.select("component", F.col("cluster").cast("int").alias("cluster")), "component").select("c", "cluster"))
    inner = flagged.where("core").join(named, "c").select("id", "cluster")
    border = links.where("not core").join(named.withColumnRenamed("c", "b"), "b").groupBy("id").agg(F.min("cluster").alias("cluster"))
    clustered = flagged.select("id", "x").join(inner.unionByName(border), "id", "left")
    return spread(points, key, clustered, ["cluster"]).select(key, F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))


def _open_pairs(dense: DataFrame, neighbours, groups: DataFrame) -> DataFrame:
    """Pairs of dense cells next to each other that no link has put into one component."""
    pairs = neighbours(dense).select("a", "b").where("a < b").join(dense.select(F.col("c").alias("b")), "b")
    one, two = (groups.select(F.col("c").alias(s), F.col("component").alias(f"g{s}")) for s in "ab")
    return cut_lineage(pairs.join(one, "a").join(two, "b").where("ga <> gb").select("a", "b"))


def _compare(pairs: DataFrame, points: DataFrame, cells: DataFrame, side: float, dims: int, limit: float, rows_per_block: int) -> DataFrame:
    """Edges between those of the ``pairs`` of cells that hold two points in reach, by all their points near the other cell."""
    box = cells.select("c", "cell", "subs")
    sized = pairs
    for s in "ab":
        sized = sized.join(box.select(F.col("c").alias(s), F.col("cell").alias(f"cell_{s}"), F.col("subs").alias(f"n_{s}")), s)

    def near(mine, other):
        rows = sized.join(points.select(F.col("c").alias(mine), "id", "x", "sub"), mine)
        rows = rows.where(_box_gap(F.col("x"), F.col(f"cell_{other}"), side, dims) <= limit)
        rows = rows.withColumn(f"s_{mine}", F.col("sub")).withColumn(f"s_{other}", F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)))
        return rows.select(*[F.col(c).alias(c) for c in ("a", "b", "s_a", "s_b", "x")])

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right) or not (sq_distances(matrix(left["x"]), matrix(right["x"])) <= limit).any():
            return pd.DataFrame({"config": [], "u": [], "v": []})
        return pd.DataFrame({"config": [0], "u": [left["a"].iloc[0]], "v": [left["b"].iloc[0]]})

    by = ["a", "b", "s_a", "s_b"]
    found = near("a", "b").groupBy(*by).cogroup(near("b", "a").groupBy(*by)).applyInPandas(meet, "config int, u bigint, v bigint")
    return cut_lineage(found.distinct())
