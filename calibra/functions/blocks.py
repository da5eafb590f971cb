"""Work on pairs of points without ever emitting the pairs.

Copies of a point are collapsed first, so a hot group of copies is one weighted point.  The
distinct points are cut into cells around sampled pivots.  Neighbouring cells are put together to
lots, about a dozen for any table, and cells larger than a lot are cut.  Two lots meet in one task, which
goes through them in blocks of bounded size and reduces every distance matrix to a result of the size of a
block (a few neighbours, a count, a sum per point).  Cells that are too far apart to matter, by the
triangle inequality, never meet.

A point travels once for each lot it meets, so the shuffle grows with the points and not with
their square, until lots reach the size a task may hold.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .sizing import cut_lineage
from .vectors import matrix, nearest_center

ROWS_PER_BLOCK = 2048
MAX_CELLS = 256
_BLOCKS_PER_CELL = 4
# Lots a table is cut into, and the rows of one at most (twice as many with its last cell).
LOTS, MAX_LOT_ROWS = 12, 65_536
# Tasks at most in a meeting of lots.
_MAX_TASKS = 2000
# Rows of results that a task holds before it puts them together.
_HELD_ROWS = 500_000
_PAIR = ["__l", "__r"]


def as_points(df: DataFrame, key: str, features: str, keep: list[str] = ()) -> DataFrame:
    """``(key, x, *keep)`` with ``x`` as ``array<double>``."""
    return df.select(F.col(key), F.col(features).cast("array<double>").alias("x"), *keep)


def collapse(points: DataFrame, key: str, keep: list[str] = ()) -> DataFrame:
    """Distinct points ``(id, x, w, *keep)``: ``id`` is the smallest key, ``w`` the number of copies."""
    return (
        points.groupBy(F.xxhash64("x").alias("__h"), "x", *keep)
        .agg(F.min(key).alias("id"), F.count(F.lit(1)).alias("w"))
        .drop("__h")
    )


def spread(points: DataFrame, key: str, distinct: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Give every original point the ``columns`` computed for its distinct point."""
    left = points.withColumn("__h", F.xxhash64("x"))
    right = distinct.select(F.xxhash64("x").alias("__h"), "x", *keep, *columns)
    return left.join(right, ["__h", "x", *keep], "left").drop("__h")


# What was made of a block of the task at hand, by block and name.
_MADE: dict[tuple[int, str], tuple[pd.DataFrame, object]] = {}


def made(frame: pd.DataFrame, name: str, make: Callable[[pd.DataFrame], object]):
    """``make(frame)``, once for a block however many others it meets."""
    known = _MADE.get((id(frame), name))
    if known is None or known[0] is not frame:
        known = _MADE[id(frame), name] = (frame, make(frame))
    return known[1]


def forget() -> None:
    """The blocks of a task are gone."""
    _MADE.clear()


def coordinates(frame: pd.DataFrame) -> np.ndarray:
    """The points of a block as a matrix."""
    return made(frame, "x", lambda f: matrix(f["x"]))


def lot_rows(total: int, rows_per_block: int) -> int:
    """Rows of a lot: a dozen lots, of one block at least."""
    return max(rows_per_block, min(-(-total // LOTS), MAX_LOT_ROWS))


def _lots(counts: np.ndarray, pivots: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First lot and number of lots of every cell; cells follow one another along the line on which the pivots lie widest."""
    order = np.arange(len(counts))
    if len(counts) > 1:
        centred = np.nan_to_num(pivots - pivots.mean(axis=0))
        order = np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")
    first, parts = np.zeros(len(counts), dtype=int), np.ones(len(counts), dtype=int)
    lot, held = 0, 0
    for c in order:
        large = counts[c] > 2 * rows
        if held and (large or held >= rows):
            lot, held = lot + 1, 0
        first[c] = lot
        held += int(counts[c])
        if large:
            parts[c] = -(-counts[c] // rows)
            lot, held = lot + parts[c], 0
    return first, parts


def _pieces(frame: pd.DataFrame, rows: int, by_cell: bool) -> list[tuple[int, pd.DataFrame]]:
    """Blocks of a lot with their cell; where all cells meet, a block may hold several."""
    if not by_cell:
        return [(0, frame.iloc[a : a + rows]) for a in range(0, len(frame), rows)]
    out = []
    for cell, part in frame.groupby("cell", sort=True):
        out += [(int(cell), part.iloc[a : a + rows]) for a in range(0, len(part), rows)]
    return out


@dataclass
class Blocks:
    """Points with their ``cell`` and ``lot``, and lower bounds of the distances between cells."""

    points: DataFrame
    pivots: np.ndarray
    radius: np.ndarray
    counts: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    rows_per_block: int

    @classmethod
    def build(cls, distinct: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> "Blocks":
        # Every pass starts from here again, so the distinct points are written once.
        distinct = cut_lineage(distinct)
        total = distinct.count()
        cells = int(min(MAX_CELLS, -(-total // (rows_per_block * _BLOCKS_PER_CELL)))) or 1
        pivots = np.empty((0, 0))
        if cells > 1:
            # Pivots: a sample by hash order, so dense regions get more of them.
            sample = distinct.select("x").orderBy(F.xxhash64("x"), "x").limit(cells).collect()
            pivots = np.array([r["x"] for r in sample], dtype=np.float64)
        return cls._assign(distinct, total, pivots, rows_per_block)

    def queries(self, distinct: DataFrame) -> "Blocks":
        """Other points cut into blocks around the same pivots."""
        distinct = cut_lineage(distinct)
        return Blocks._assign(distinct, distinct.count(), self.pivots, self.rows_per_block)

    @classmethod
    def _assign(cls, distinct, total, pivots, rows_per_block):
        if len(pivots) <= 1:
            counts, radius = np.array([total]), np.array([np.inf])
            placed = distinct.withColumn("cell", F.lit(0))
        else:
            near = distinct.withColumn("__n", nearest_center("x", pivots))
            near = near.withColumn("cell", F.col("__n")["cluster"]).withColumn("__r", F.sqrt(F.col("__n")["sq"]))
            # Found once, not in every pass.
            near = cut_lineage(near.drop("__n"))
            counts, radius = np.zeros(len(pivots), dtype=int), np.zeros(len(pivots))
            # One row per pivot.
            for r in near.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("__r").alias("r")).collect():
                counts[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
            placed = near.drop("__r")
        first, parts = _lots(counts, pivots, lot_rows(total, rows_per_block))
        firsts, sizes = (F.array(*[F.lit(int(v)) for v in values]) for values in (first, parts))
        at = F.pmod(F.xxhash64("id"), F.get(sizes, F.col("cell"))).cast("int")
        return cls(placed.withColumn("lot", F.get(firsts, F.col("cell")) + at), pivots, radius, counts, first, parts, rows_per_block)

    def lots(self) -> np.ndarray:
        """Which lots every cell has points in: cells x lots."""
        numbers = np.arange(int((self.first + self.parts).max()))[None, :]
        return (numbers >= self.first[:, None]) & (numbers < (self.first + self.parts)[:, None]) & (self.counts > 0)[:, None]

    def gaps(self, other: "Blocks") -> np.ndarray:
        """Lower bound of the distance between any point of a cell here and of a cell of ``other``."""
        if len(self.pivots) <= 1:
            return np.zeros((1, 1))
        bound = self.between() - self.radius[:, None] - other.radius[None, :]
        # Rounding must never hide a neighbour.
        return np.maximum(bound - 1e-9 * (1.0 + self.between()), 0.0)

    def between(self) -> np.ndarray:
        """Distances of the pivots."""
        return np.sqrt(((self.pivots[:, None, :] - self.pivots[None, :, :]) ** 2).sum(axis=-1))

    def within(self, other: "Blocks", reach=None) -> np.ndarray:
        """Which cells must meet: those within ``reach`` (one distance or one per cell), or all."""
        if reach is None:
            return np.ones((len(self.counts), len(other.counts)), dtype=bool)
        return self.gaps(other) <= np.broadcast_to(np.asarray(reach, dtype=float), (len(self.counts),))[:, None]

    def meet(
        self, other: "Blocks", near: np.ndarray, fn, schema: str, left: DataFrame = None, right: DataFrame = None, half: bool = False,
        merge: Callable[[pd.DataFrame], pd.DataFrame] | None = None, across: bool = False, sweep: bool = False,
    ) -> DataFrame:
        """Run ``fn(block of self, block of other)`` on the pairs of blocks whose cells are ``near``.

        ``left`` and ``right`` may replace the points by frames that carry other columns.  With
        ``half`` each pair of blocks of one table meets once (``near`` is symmetric then).  ``merge`` puts
        together what one block here has left with all blocks of a lot, and with ``across`` all blocks of both lots.
        With ``sweep`` a task is one call
        ``fn(blocks here, blocks of other, met)``, where ``met[i]`` are the numbers of the blocks that block ``i`` meets;
        met with itself a lot is one list of blocks.
        """
        lots = self.lots().T.astype(int) @ near.astype(int) @ other.lots().astype(int) > 0
        # A row for each pair of lots, a few hundred up to MAX_LOT_ROWS * LOTS points.
        pairs = [(int(i), int(j)) for i, j in zip(*np.nonzero(lots)) if not half or i <= j]
        table = self.points.sparkSession.createDataFrame(pairs, "__l int, __r int")
        tasks = max(1, min(len(pairs), _MAX_TASKS))
        rows, by_cell = self.rows_per_block, not near.all()

        def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            mine = _pieces(a, rows, by_cell)
            alone = half and key[0] == key[1]
            theirs = mine if alone else _pieces(b, rows, by_cell)
            forget()
            if sweep:
                met = [[j for j, (d, _) in enumerate(theirs) if (not by_cell or near[c, d]) and not (alone and j < i)] for i, (c, _) in enumerate(mine)]
                blocks = [f for _, f in mine]
                return fn(blocks, blocks if alone else [f for _, f in theirs], met)
            out, held = [], 0
            for i, (c, block) in enumerate(mine):
                found = [fn(block, o) for j, (d, o) in enumerate(theirs) if (not by_cell or near[c, d]) and not (alone and j < i)]
                found = [f for f in found if len(f)]
                if not found:
                    continue
                part = pd.concat(found, ignore_index=True)
                out.append(merge(part) if merge and not across and len(found) > 1 else part)
                held += len(part)
                if across and held > _HELD_ROWS:
                    out = [merge(pd.concat(out, ignore_index=True))]
                    held = 0
            if not out:
                return fn(a.iloc[:0], b.iloc[:0])
            total = pd.concat(out, ignore_index=True)
            return merge(total) if across else total

        a = (left if left is not None else self.points).join(F.broadcast(table), F.col("lot") == F.col("__l")).drop("lot")
        b = (right if right is not None else other.points).join(F.broadcast(table), F.col("lot") == F.col("__r")).drop("lot")
        # Both sides may stem from one frame; new column identities keep them apart.
        a, b = (f.select(*[F.col(c).alias(c) for c in f.columns]).repartition(tasks, *_PAIR) for f in (a, b))
        return a.groupBy(*_PAIR).cogroup(b.groupBy(*_PAIR)).applyInPandas(run, schema)
