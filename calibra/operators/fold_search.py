"""Searches over penalised polynomial regressions from sums per fold.

One pass over the table leaves, for every fold, the products of all polynomial terms and the label.
Training sums are those of all folds less the fold itself, terms are standardised from them, and every
candidate is fitted and scored on such sums alone: ridge by one eigendecomposition for all strengths
of a fold and degree, lasso by coordinate descent for all of them at once.  Thousands of fits cost one scan.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.vectors import matrix

MAX_TERMS, LOTS = 1000, 64
ROUNDS, TOLERANCE = 10_000, 1e-10


def term_list(dims: int, degree: int) -> list[tuple[int, ...]]:
    """Feature numbers of every term, by degree; those of a lower degree come first."""
    return [c for d in range(1, degree + 1) for c in combinations_with_replacement(range(dims), d)]


def expand(x: np.ndarray, terms: list[tuple[int, ...]]) -> np.ndarray:
    """All terms of the rows of ``x``; each is one feature times a shorter term."""
    out, at = np.empty((len(x), len(terms))), {}
    for i, t in enumerate(terms):
        at[t] = i
        out[:, i] = x[:, t[0]] if len(t) == 1 else out[:, at[t[:-1]]] * x[:, t[-1]]
    return out


@dataclass
class FoldSums:
    """Per fold the products of ``(1, terms, label)`` with themselves; features are divided by ``scale``."""

    dims: int
    degree: int
    scale: np.ndarray
    sums: np.ndarray

    def terms(self, degree: int) -> int:
        return len(term_list(self.dims, degree))

    def part(self, sums: np.ndarray, degree: int) -> np.ndarray:
        """The products of the terms up to a degree."""
        at = [*range(self.terms(degree) + 1), len(sums) - 1]
        return sums[np.ix_(at, at)]


def fold_sums(df: DataFrame, features: str, label: str, fold: str, k: int, degree: int) -> FoldSums:
    """The sums of ``k`` folds, numbered from 0, for terms up to ``degree`` of an array column.

    Rows with a missing feature, label or fold take no part.
    """
    x = F.col(features).cast("array<double>")
    rows = df.select(x.alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("fold"))
    rows = rows.where(F.col("y").isNotNull() & F.col("fold").between(0, k - 1) & F.col("x").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v)))
    dims = rows.agg(F.max(F.size("x"))).first()[0] or 1
    # One row; scaling keeps high powers from overflowing and drops out again when terms are standardised.
    largest = rows.agg(*[F.max(F.abs(F.get("x", F.lit(i)))).alias(f"m{i}") for i in range(dims)]).first()
    scale = np.array([v if v else 1.0 for v in largest])
    terms = term_list(dims, degree)
    if len(terms) > MAX_TERMS:
        raise ValueError(f"{len(terms)} terms, at most {MAX_TERMS}")
    width = len(terms) + 2

    def products(frames):
        total = np.zeros((k, width, width))
        for frame in frames:
            z = np.column_stack([np.ones(len(frame)), expand(matrix(frame["x"]) / scale, terms), frame["y"].to_numpy()])
            at = frame["fold"].to_numpy()
            for f in np.unique(at).tolist():
                total[f] += z[at == f].T @ z[at == f]
        yield pd.DataFrame({"fold": range(k), "sums": [t.tobytes() for t in total]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in frame["sums"])
        return frame.iloc[:1].assign(sums=[total.tobytes()])

    parts = rows.mapInPandas(products, "fold int, sums binary").withColumn("lot", F.pmod(F.spark_partition_id(), F.lit(LOTS)))
    lots = parts.groupBy("fold", "lot").applyInPandas(add, "fold int, sums binary, lot int")
    # One matrix for each fold.
    found = {r["fold"]: r["sums"] for r in lots.groupBy("fold").applyInPandas(add, "fold int, sums binary, lot int").collect()}
    empty = np.zeros((width, width)).tobytes()
    return FoldSums(dims, degree, scale, np.stack([np.frombuffer(found.get(f, empty)).reshape(width, width) for f in range(k)]))


class Standardised:
    """Means, deviations and correlations of the terms in some sums; constant terms have no slope."""

    def __init__(self, sums: np.ndarray):
        self.n = sums[0, 0]
        self.mean = sums[0, 1:-1] / self.n
        self.label_mean = sums[0, -1] / self.n
        cov = sums[1:-1, 1:-1] / self.n - np.outer(self.mean, self.mean)
        self.deviation = np.sqrt(np.maximum(np.diag(cov), 0.0))
        self.varies = self.deviation > 1e-12 * (1.0 + np.abs(self.mean))
        inverse = np.where(self.varies, 1.0 / np.where(self.varies, self.deviation, 1.0), 0.0)
        self.correlation = cov * np.outer(inverse, inverse)
        self.with_label = (sums[1:-1, -1] / self.n - self.mean * self.label_mean) * inverse
        self.inverse = inverse

    def ridge(self, strengths: np.ndarray) -> np.ndarray:
        values, vectors = np.linalg.eigh(self.correlation)
        turned = vectors.T @ self.with_label
        return (turned / (np.maximum(values, 0.0) + strengths[:, None] / self.n)) @ vectors.T

    def lasso(self, strengths: np.ndarray) -> np.ndarray:
        slopes = np.zeros((len(strengths), len(self.mean)))
        for _ in range(ROUNDS):
            moved = 0.0
            for j in np.flatnonzero(self.varies).tolist():
                pull = self.with_label[j] - slopes @ self.correlation[:, j] + slopes[:, j]
                new = np.sign(pull) * np.maximum(np.abs(pull) - strengths, 0.0)
                moved = max(moved, float(np.abs(new - slopes[:, j]).max()))
                slopes[:, j] = new
            if moved <= TOLERANCE * (float(np.abs(self.with_label).max(initial=0.0)) + 1e-300):
                break
        return slopes

    def fit(self, model: str, strengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intercepts and slopes on the terms as they are, a row for each strength."""
        slopes = {"ridge": self.ridge, "lasso": self.lasso}[model](strengths) * self.inverse
        return self.label_mean - slopes @ self.mean, slopes


def r2(sums: np.ndarray, intercepts: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    """Coefficient of determination of each line on the rows behind ``sums``."""
    line = np.column_stack([intercepts, slopes, np.full(len(slopes), -1.0)])
    off = np.einsum("ci,ij,cj->c", line, sums, line)
    around = sums[-1, -1] - sums[0, -1] ** 2 / sums[0, 0]
    return 1.0 - off / around


@dataclass
class LinearSearch:
    """Scores of every candidate, ``(candidate, model, degree, strength, mean, std, best)``, and the best one."""

    table: DataFrame
    model: str
    degree: int
    strength: float
    score: float


def search(spark, sums: FoldSums, candidates: list[tuple[str, int, float]]) -> LinearSearch:
    """Fit and score ``(model, degree, strength)`` candidates on every fold; the first of equal scores wins.

    ``strength`` is alpha on standardised terms: of the sum of squares for ridge, of half its mean for
    lasso.  Fits are dealt out by fold, model and degree.
    """
    folds = np.arange(len(sums.sums))
    listed = spark.createDataFrame([(i, m, d, float(s)) for i, (m, d, s) in enumerate(candidates)], "candidate int, model string, degree int, strength double")
    shared = spark.sparkContext.broadcast(sums)

    def score(frame: pd.DataFrame) -> pd.DataFrame:
        held, f, d = shared.value, int(frame["fold"].iloc[0]), int(frame["degree"].iloc[0])
        inside, outside = held.part(held.sums[f], d), held.part(held.sums.sum(axis=0) - held.sums[f], d)
        lines = Standardised(outside).fit(frame["model"].iloc[0], frame["strength"].to_numpy())
        return frame[["candidate", "fold"]].assign(r2=r2(inside, *lines))

    each = listed.withColumn("fold", F.explode(F.array(*[F.lit(int(f)) for f in folds])))
    # A number of its own keeps the few rows, and long fits, from being drawn together into one task.
    groups = len(folds) * len({(m, d) for m, d, _ in candidates})
    dealt = each.repartition(min(2 * groups, 200), "fold", "model", "degree")
    scored = dealt.groupBy("fold", "model", "degree").applyInPandas(score, "candidate int, fold int, r2 double")
    # A row for each candidate, and the candidates came from the caller.
    means = scored.groupBy("candidate").agg(F.avg("r2").alias("mean"), F.stddev_pop("r2").alias("std")).collect()
    means = {r["candidate"]: (r["mean"], r["std"]) for r in means}
    best = min(means, key=lambda c: (-means[c][0], c))
    rows = [(i, m, d, float(s), *means[i], i == best) for i, (m, d, s) in enumerate(candidates)]
    table = spark.createDataFrame(rows, "candidate int, model string, degree int, strength double, mean double, std double, best boolean")
    return LinearSearch(table, *candidates[best], means[best][0])


def draws(n: int, seed: int, model: str, degrees: list[int], strength: Callable) -> list[tuple[str, int, float]]:
    """``n`` seeded candidates; ``strength`` draws from a generator, as ``search.log_uniform`` does."""
    rng = random.Random(seed)
    return [(model, rng.choice(degrees), strength(rng)) for _ in range(n)]


def better(first: LinearSearch, second: LinearSearch) -> LinearSearch:
    """The search with the better best candidate; a tie goes to the first."""
    return second if second.score > first.score else first


def refit(sums: FoldSums, model: str, degree: int, strength: float) -> tuple[float, dict[tuple[int, ...], float]]:
    """Intercept and coefficients by term of a candidate fitted to all folds, for features as they are."""
    intercepts, slopes = Standardised(sums.part(sums.sums.sum(axis=0), degree)).fit(model, np.array([float(strength)]))
    terms = term_list(sums.dims, degree)
    return float(intercepts[0]), {t: float(b) / math.prod(sums.scale[i] for i in t) for t, b in zip(terms, slopes[0])}


def predicted(features: str, intercept: float, coefficients: dict[tuple[int, ...], float]) -> Column:
    """The fitted polynomial as a column expression."""
    x = F.col(features).cast("array<double>")
    out = F.lit(intercept)
    for term, b in coefficients.items():
        product = F.lit(b)
        for i in term:
            product = product * F.get(x, F.lit(i))
        out = out + product
    return out
