"""Approximate nearest neighbours: p-stable projections in several tables, exact distances on candidates.

A table cuts space into boxes: every projection onto a random direction is divided into intervals.
A point lies in one box of each table and asks in that box and in the ``probes`` neighbouring ones
whose walls are closest to it.  Boxes are made as large as a block of points, so that a box is one
matrix of distances; larger boxes are cut into blocks, and so are the points that ask there.  A
point travels ``tables * (1 + probes)`` times whatever the size of the table, where the exact search
sends it once per block.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.blocks import ROWS_PER_BLOCK, as_points, collapse, spread
from ..functions.sizing import cut_lineage
from ..functions.vectors import matrix
from .neighbors import _first_members, _k_nearest, _nearest_block, _type

TABLES, PROJECTIONS, PROBES, SEED = 8, 4, 6, 7
# Distinct points of the sample to which the intervals are fitted, and how much fuller than asked a point's box may be by it.
FITTED, CROWDED = 8192, 3
# Points on either side of a box that meet in one task, block by block.
TASK_POINTS = 16_384


@dataclass
class Boxes:
    """Directions (dimension x table x projection), interval widths and offsets of all tables."""

    directions: np.ndarray
    widths: np.ndarray
    shifts: np.ndarray
    probes: int

    @classmethod
    def of(cls, distinct: DataFrame, tables: int, projections: int, probes: int, rows_per_box: int, width: float | None, seed: int) -> "Boxes":
        """Intervals of ``width``, or as many a projection as cut the table into boxes of about ``rows_per_box``."""
        rng = np.random.default_rng(seed)
        dim = distinct.agg(F.max(F.size("x"))).first()[0] or 1
        directions = rng.standard_normal((dim, tables, projections))
        shifts = rng.random((tables, projections))
        if width is not None:
            return cls(directions, np.full((tables, projections), float(width)), shifts, probes)
        total, first, second = _projected_moments(distinct, directions)
        spread_ = np.sqrt(np.maximum(second / max(total, 1) - (first / max(total, 1)) ** 2, 0.0))
        # Most of a projection lies within two deviations of its mean.
        parts = max((total / rows_per_box) ** (1.0 / projections), 1e-3)
        widths = np.where(spread_ > 0, 4.0 * spread_ / parts, 1.0)
        return cls(directions, widths / _finer(distinct, directions, widths, shifts, total, rows_per_box)[:, None], shifts, probes)

    def keys(self, x: np.ndarray, probing: bool) -> np.ndarray:
        """Box numbers by row, table and probe; the first probe is the own box."""
        at = np.einsum("nd,dtp->ntp", x, self.directions, optimize=True) / self.widths + self.shifts
        low = np.floor(at)
        tables, projections = self.widths.shape
        odd = np.random.default_rng(projections).integers(1, 1 << 62, projections, dtype=np.int64) * 2 + 1
        own = (low.astype(np.int64) * odd).sum(axis=2)
        if not probing or not self.probes:
            return own[:, :, None]
        inside = at - low
        # One step down or up along a projection costs the squared way to that wall.
        steps = [(p, s) for p in range(projections) for s in (-1, 1)]
        cost = np.stack([(inside[..., p] if s < 0 else 1.0 - inside[..., p]) ** 2 for p, s in steps], axis=2)
        move = np.array([s * int(odd[p]) for p, s in steps], dtype=np.int64)
        sets = [(a,) for a in range(len(steps))] + [(a, b) for a, b in combinations(range(len(steps)), 2) if steps[a][0] != steps[b][0]]
        costs = np.stack([cost[..., list(s)].sum(axis=2) for s in sets], axis=2)
        moves = np.array([move[list(s)].sum() for s in sets], dtype=np.int64)
        best = np.argsort(costs, axis=2, kind="stable")[..., : self.probes]
        return np.concatenate([own[:, :, None], own[:, :, None] + moves[best]], axis=2)


def _finer(distinct: DataFrame, directions: np.ndarray, widths: np.ndarray, shifts: np.ndarray, total: int, rows_per_box: int) -> np.ndarray:
    """Factor by which the intervals of each table have to shrink.

    Points along few directions, or in lumps, fill fewer boxes than intervals of all projections make.  How many
    points share the box of one is estimated from the pairs of a sample, by hash order.
    """
    factors = np.ones(widths.shape[0])
    if total <= CROWDED * rows_per_box:
        return factors
    x = np.array([r["x"] for r in distinct.select("x").orderBy(F.xxhash64("x"), "x").limit(FITTED).collect()], dtype=np.float64)
    at = np.einsum("nd,dtp->tnp", x, directions, optimize=True)
    for t in range(len(factors)):
        while factors[t] < 2.0**40:
            boxes = np.floor(at[t] * factors[t] / widths[t] + shifts[t])
            n = np.unique(boxes, axis=0, return_counts=True)[1]
            if total * (n * (n - 1.0)).sum() / (len(x) * (len(x) - 1.0)) <= CROWDED * rows_per_box:
                break
            factors[t] *= 1.5
    return factors


def _projected_moments(distinct: DataFrame, directions: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, sums and sums of squares of every projection."""
    tables, projections = directions.shape[1:]

    def run(frames):
        n, first, second = 0, np.zeros(tables * projections), np.zeros(tables * projections)
        for frame in frames:
            y = matrix(frame["x"]) @ directions.reshape(len(directions), -1)
            n, first, second = n + len(y), first + y.sum(axis=0), second + (y * y).sum(axis=0)
        if n:
            yield pd.DataFrame({"at": np.arange(len(first)), "n": n, "first": first, "second": second})

    parts = distinct.select("x").mapInPandas(run, "at int, n bigint, first double, second double")
    # A row for each table and projection.
    rows = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("first").alias("a"), F.sum("second").alias("b")).orderBy("at").collect()
    if not rows:
        return 0, np.zeros((tables, projections)), np.zeros((tables, projections))
    return rows[0]["n"], *(np.array([r[c] for r in rows]).reshape(tables, projections) for c in ("a", "b"))


def _in_blocks(step, merge):
    """``step`` on the blocks of two groups of points, a matrix of distances at a time."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a in range(0, len(left), ROWS_PER_BLOCK):
            block = left.iloc[a : a + ROWS_PER_BLOCK]
            found = [step(block, right.iloc[b : b + ROWS_PER_BLOCK]) for b in range(0, len(right), ROWS_PER_BLOCK)]
            out += [merge(pd.concat(found, ignore_index=True))] if len(found) > 1 else found
        return pd.concat(out, ignore_index=True) if out else step(left, right)

    return run


def knn_lsh(
    df: DataFrame,
    key: str,
    features: str,
    k: int,
    include_self: bool = False,
    queries: DataFrame | None = None,
    payload: list[str] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    probes: int = PROBES,
    width: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``(key, rank, neighbor, distance, *payload)``: the ``k`` nearest of the rows found, as :func:`neighbors.knn` gives them.

    Distances are exact and copies are never missed; a neighbour is missed where no table brings it
    together with the row.  More ``tables`` or ``probes``, or a larger ``width``, miss fewer.
    Rows for which fewer than ``k`` others were found have as many.
    """
    payload = list(payload)
    points = as_points(df, key, features, payload)
    wanted = k + 1
    distinct = cut_lineage(collapse(points, key).join(_first_members(points, key, payload, wanted, once=True), "x"))
    boxes = Boxes.of(distinct, tables, projections, probes, rows_per_block, width, seed)
    asked = points if queries is None else as_points(queries, key, features)
    asking = distinct.select("id", "x") if queries is None else cut_lineage(collapse(asked, key)).select("id", "x")

    def boxed(frame, probing):
        @F.pandas_udf("array<array<bigint>>")
        def keys(x: pd.Series) -> pd.Series:
            return pd.Series(list(map(lambda r: [v.tolist() for v in r], boxes.keys(matrix(x), probing))))

        each = frame.withColumn("__t", keys.asNondeterministic()("x"))
        each = each.select("*", F.posexplode("__t").alias("t", "__b")).drop("__t")
        return each.withColumn("box", F.explode("__b")).drop("__b")

    def parts(frame, name):
        return frame.groupBy("t", "box").agg(F.ceil(F.count(F.lit(1)) / max(TASK_POINTS, rows_per_block)).cast("int").alias(name))

    left, right = boxed(asking, True), boxed(distinct.drop("w"), False)
    # Boxes that hold points and are asked for, with the blocks on either side.
    sizes = cut_lineage(parts(right.select("t", "box"), "rn").join(parts(left.select("t", "box"), "ln"), ["t", "box"]))

    def placed(frame, own, others, own_n, others_n):
        cut = frame.join(sizes, ["t", "box"]).withColumn(own, F.pmod(F.xxhash64("id", F.lit(own)), F.col(own_n)).cast("int"))
        return cut.withColumn(others, F.explode(F.sequence(F.lit(0), F.col(others_n) - 1))).drop("ln", "rn")

    a, b = placed(left, "ls", "rs", "ln", "rn"), placed(right, "rs", "ls", "rn", "ln")
    a, b = (f.select(*[F.col(c).alias(c) for c in f.columns]) for f in (a, b))
    schema = f"id {_type(points, key)}, distance double, neighbor {_type(points, key)}"
    schema += "".join(f", `{p}` {_type(points, p)}" for p in payload)
    meet = ["t", "box", "ls", "rs"]
    found = a.groupBy(*meet).cogroup(b.groupBy(*meet)).applyInPandas(_in_blocks(_nearest_block(wanted, payload), _k_nearest(wanted)), schema)
    # The same neighbour may be found in several tables.
    near = found.groupBy("id").agg(F.slice(F.sort_array(F.collect_set(F.struct("distance", "neighbor", *payload))), 1, wanted).alias("near"))
    own = asking.join(near, "id", "left")
    rows = spread(asked, key, own, ["near"]).select(key, "near")
    if queries is None:
        others = F.slice(F.filter("near", lambda e: e["neighbor"] != F.col(key)), 1, k - 1 if include_self else k)
    else:
        others = F.slice("near", 1, k)
    shift = 2 if include_self and queries is None else 1
    out = rows.select(key, F.posexplode(others).alias("at", "e")).select(
        key, (F.col("at") + shift).alias("rank"), F.col("e")["neighbor"].alias("neighbor"),
        F.col("e")["distance"].alias("distance"), *[F.col("e")[p].alias(p) for p in payload],
    )
    if shift == 2:
        selves = df.select(key, F.lit(1).alias("rank"), F.col(key).alias("neighbor"), F.lit(0.0).alias("distance"), *payload)
        out = out.unionByName(selves)
    return out


def recall(found: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    """``(wanted, found, recall)``: how many of the exact neighbours are among those found, by key and neighbour."""
    hit = exact.select(key, "neighbor").join(found.select(key, "neighbor").withColumn("hit", F.lit(1)), [key, "neighbor"], "left")
    return hit.agg(F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("found")).withColumn(
        "recall", F.try_divide(F.col("found"), F.col("wanted"))
    )
