"""Cross-validation, grid and random search over reproducible folds."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, functions as F

PARALLELISM = 4


def scorer(metric: str, label: str = "label") -> Evaluator:
    """``accuracy``, ``f1`` (weighted), ``f1_binary`` (of class 1), ``weightedPrecision`` ..., or ``r2``, ``rmse``, ``mae``."""
    if metric in ("r2", "rmse", "mae", "mse"):
        return RegressionEvaluator(metricName=metric, labelCol=label)
    if metric == "f1_binary":
        return MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0, beta=1.0, labelCol=label)
    return MulticlassClassificationEvaluator(metricName=metric, labelCol=label)


@dataclass
class SearchResult:
    """The refitted best model, its parameters and score, and the score of every candidate."""

    model: Model
    params: dict
    score: float
    table: DataFrame


def _validated(estimator, maps, df, fold, k, evaluator, parallelism) -> CrossValidator:
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=k, foldCol=fold, parallelism=parallelism
    ).fit(df)


def cross_val(models: dict, df: DataFrame, fold: str, k: int, evaluator: Evaluator, parallelism: int = PARALLELISM) -> DataFrame:
    """``(model, mean, std)``: mean and population deviation of the fold scores, best first."""
    rows = []
    for name, estimator in models.items():
        fitted = _validated(estimator, [{}], df, fold, k, evaluator, parallelism)
        rows.append((name, float(fitted.avgMetrics[0]), float(fitted.stdMetrics[0])))
    table = df.sparkSession.createDataFrame(rows, "model string, mean double, std double")
    better = F.desc("mean") if evaluator.isLargerBetter() else F.asc("mean")
    return table.orderBy(better, "model")


def _search(estimator, maps, df, fold, k, evaluator, parallelism) -> SearchResult:
    fitted = _validated(estimator, maps, df, fold, k, evaluator, parallelism)
    scores = fitted.avgMetrics
    pick = max if evaluator.isLargerBetter() else min
    best = scores.index(pick(scores))
    named = [{p.name: v for p, v in m.items()} for m in maps]
    rows = [
        (i, {n: str(v) for n, v in m.items()}, float(s), float(d), i == best)
        for i, (m, s, d) in enumerate(zip(named, scores, fitted.stdMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "candidate int, params map<string,string>, mean double, std double, best boolean"
    )
    return SearchResult(fitted.bestModel, named[best], float(scores[best]), table)


def grid_search(estimator, grid: dict, df: DataFrame, fold: str, k: int, evaluator: Evaluator, parallelism: int = PARALLELISM) -> SearchResult:
    """Try every combination of ``{param: values}``; the first of equal scores wins."""
    maps = [{}]
    for param, values in grid.items():
        maps = [{**m, param: v} for m in maps for v in values]
    return _search(estimator, maps, df, fold, k, evaluator, parallelism)


def log_uniform(low: float, high: float):
    """Draws whose logarithm is uniform."""
    return lambda rng: math.exp(rng.uniform(math.log(low), math.log(high)))


def choice(values: list):
    return lambda rng: rng.choice(values)


def random_search(
    estimator, draws: dict, n: int, seed: int, df: DataFrame, fold: str, k: int, evaluator: Evaluator,
    parallelism: int = PARALLELISM,
) -> SearchResult:
    """Try ``n`` seeded draws of ``{param: draw}``."""
    rng = random.Random(seed)
    maps = [{param: draw(rng) for param, draw in draws.items()} for _ in range(n)]
    return _search(estimator, maps, df, fold, k, evaluator, parallelism)


def select_best(first: SearchResult, second: SearchResult, larger: bool = True) -> SearchResult:
    """The better of two searches; a tie goes to the first."""
    wins = second.score > first.score if larger else second.score < first.score
    return second if wins else first
