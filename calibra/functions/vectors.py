"""Small numeric kernels on feature arrays; Spark hands them Arrow batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def feature_array(cols: list[str]) -> Column:
    """Several numeric columns as one ``array<double>``."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def matrix(series: pd.Series) -> np.ndarray:
    """A column of equal-length arrays as a two-dimensional array."""
    return np.stack(series.to_numpy()).astype(np.float64) if len(series) else np.empty((0, 0))


def nearest_center(features: str | Column, centers) -> Column:
    """``struct(cluster, sq)``: index of and squared distance to the nearest center, ties to the lowest index."""
    table = np.asarray(centers, dtype=np.float64)

    @F.pandas_udf("cluster int, sq double")
    def nearest(x: pd.Series) -> pd.DataFrame:
        rows = matrix(x)
        sq = np.stack([((rows - c) ** 2).sum(axis=1) for c in table], axis=1)
        return pd.DataFrame({"cluster": sq.argmin(axis=1).astype("int32"), "sq": sq.min(axis=1)})

    return nearest(features)


def element_means(df: DataFrame, by: list[str], features: str, size: int) -> DataFrame:
    """Per group: row count and the array of element means."""
    means = [F.avg(F.col(features)[i]) for i in range(size)]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.array(*means).alias("center"))


# Rows of a strip of a distance matrix: small enough to stay in the cache from the product to the last look at it.
_STRIP = 256


def _near_origin(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both blocks moved by one row of theirs, where they lie far from the origin for their extent; else as they are.

    The error of a product grows with the lengths of the rows, and with it the pairs that need a second look.
    """
    if not len(a) or not len(b) or not a.shape[1]:
        return a, b
    row = b[len(b) // 2]
    before = max((a * a).sum(axis=1).max(), (b * b).sum(axis=1).max())
    if not 0.0 < before < np.inf:
        return a, b
    moved_a, moved_b = a - row, b - row
    after = max((moved_a * moved_a).sum(axis=1).max(), (moved_b * moved_b).sum(axis=1).max())
    return (moved_a, moved_b) if after * 16.0 < before else (a, b)


def sq_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between two blocks of rows.

    The matrix product is fast but loses digits for close points, so those are recomputed from
    the differences; identical rows get exactly zero.
    """
    rows_a, rows_b = a, b
    a, b = _near_origin(a, b)
    na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    # One product gives |a|^2 - 2ab + |b|^2.
    left, right = np.column_stack([-2.0 * a, na, np.ones(len(a))]), np.column_stack([b, np.ones(len(b)), nb]).T
    sq = np.empty((len(a), len(b)))
    top = 1e-4 * (np.fmax.reduce(na, initial=0.0) + np.fmax.reduce(nb, initial=0.0))
    step = max(1, 4_000_000 // max(a.shape[1], 1))
    for r in range(0, len(a) if len(b) else 0, _STRIP):
        part = sq[r : r + _STRIP]
        np.matmul(left[r : r + _STRIP], right, out=part)
        np.maximum(part, 0.0, out=part)
        i, j = np.divmod(np.flatnonzero(part <= top), len(b))
        close = part[i, j] <= 1e-4 * (na[i + r] + nb[j])
        i, j = i[close], j[close]
        for s in range(0, len(i), step):
            at = slice(s, s + step)
            part[i[at], j[at]] = ((rows_a[i[at] + r] - rows_b[j[at]]) ** 2).sum(axis=1)
    return sq


def pair_squares(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances of rows ``i`` of one block and ``j`` of another from their differences, a few at a time."""
    out, step = np.empty(len(i)), max(1, 1_000_000 // max(a.shape[1], 1))
    for s in range(0, len(i), step):
        at = slice(s, s + step)
        out[at] = ((a[i[at]] - b[j[at]]) ** 2).sum(axis=-1)
    return out


class Near:
    """Pairs of rows of two blocks within given distances: exact, though single precision sorts out most of them.

    Pairs that its error leaves open are measured from their differences.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b = a, b
        a, b = _near_origin(a, b)
        na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
        self.top = float(max(na.max(initial=0.0), nb.max(initial=0.0)))
        # Nothing to scale by, or not a number: all in double precision.
        self.plain = None if 0.0 < self.top < np.inf else sq_distances(self.a, self.b)
        # Of rows no longer than 1: a product of d + 2 terms, their absolute values at most 2 together; twice the bound of its error.
        self.margin = (a.shape[1] + 8) * 2.0**-22
        if self.plain is None:
            # One product gives minus half the squared distance, in units of the longest row.
            unit = 1.0 / np.sqrt(self.top)
            self.left = np.column_stack([a * unit, -0.5 * na / self.top, np.ones(len(a))]).astype(np.float32)
            self.right = np.column_stack([b * unit, np.ones(len(b)), -0.5 * nb / self.top]).astype(np.float32).T

    def strips(self):
        """``(first row, minus half the squared distances by the longest)`` in single precision."""
        for r in range(0, len(self.a), _STRIP):
            yield r, self.left[r : r + _STRIP] @ self.right

    def masks(self, limits: list[float]) -> list[np.ndarray]:
        """For each limit, which pairs have a squared distance up to it."""
        if self.plain is not None:
            return [self.plain <= s for s in limits]
        held = [np.empty((len(self.a), len(self.b)), dtype=bool) for _ in limits]
        for r, half in self.strips():
            for mask, limit in zip(held, limits):
                part = mask[r : r + _STRIP]
                middle = -0.5 * min(limit / self.top, 16.0)
                np.greater_equal(half, np.float32(middle + self.margin), out=part)
                i, j = np.divmod(np.flatnonzero((half >= np.float32(middle - self.margin)) != part), len(self.b))
                if len(i) * 16 > part.size:
                    part[:] = sq_distances(self.a[r : r + _STRIP], self.b) <= limit
                elif len(i):
                    part[i, j] = pair_squares(self.a, i + r, self.b, j) <= limit
        return held

    def candidates(self, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows that may have a squared distance up to the limit of the left row, none missing."""
        if self.plain is not None:
            return np.nonzero(self.plain <= (limits * (1 + 1e-9))[:, None])
        found = []
        low = (-0.5 * np.minimum(limits / self.top, 16.0) - self.margin).astype(np.float32)
        for r, half in self.strips():
            i, j = np.divmod(np.flatnonzero(half >= low[r : r + _STRIP, None]), len(self.b))
            found.append((i + r, j))
        return tuple(np.concatenate(f) for f in zip(*found)) if found else (np.empty(0, dtype=int),) * 2


def direct_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of row pairs from their differences: equal rows give bitwise equal results."""
    return np.sqrt(((a - b) ** 2).sum(axis=-1))
