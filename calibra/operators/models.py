"""Supervised models: penalties with their usual meaning, importances, coefficients, scoring.

The penalised estimators read the row count (and target deviation) of the table they are fitted
on, so ``C`` and ``alpha`` mean the same in every fold of a search and on the whole table.
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, functions as F

# Bytes of kernel features that one task reads in a pass.
TASK_BYTES = 64 << 20
# Spark's deepest tree, used where no depth limit is asked for.
DEEPEST = 30


class _Penalized(Estimator, HasFeaturesCol, HasLabelCol):
    """An estimator with one penalty parameter, converted at fit time."""

    strength = Param(Params._dummy(), "strength", "penalty: C, or alpha", TypeConverters.toFloat)

    def __init__(self, strength: float = 1.0, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self._setDefault(strength=1.0)
        self._set(strength=strength, featuresCol=featuresCol, labelCol=labelCol)

    def _columns(self) -> dict:
        return {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol()}


class Logistic(_Penalized):
    """L2 logistic regression, two or more classes; ``strength`` is C, larger is weaker."""

    def _fit(self, dataset):
        reg = 1.0 / (self.getOrDefault(self.strength) * dataset.count())
        return LogisticRegression(regParam=reg, standardization=False, maxIter=1000, tol=1e-8, **self._columns()).fit(dataset)


class Ridge(_Penalized):
    """Squared-penalty regression; ``strength`` is alpha.  Solved by normal equations."""

    def _fit(self, dataset):
        y = F.col(self.getLabelCol())
        row = dataset.agg(F.count(y).alias("n"), F.stddev_pop(y).alias("s")).first()
        reg = self.getOrDefault(self.strength) * (row["s"] or 0.0) / row["n"]
        return LinearRegression(
            regParam=reg, elasticNetParam=0.0, solver="normal", standardization=False, **self._columns()
        ).fit(dataset)


class Lasso(_Penalized):
    """Absolute-penalty regression; ``strength`` is alpha."""

    def _fit(self, dataset):
        return LinearRegression(
            regParam=self.getOrDefault(self.strength), elasticNetParam=1.0, standardization=False,
            maxIter=1000, tol=1e-9, **self._columns(),
        ).fit(dataset)


def tree_classifier(max_depth: int | None = None, min_leaf: int = 1, criterion: str = "gini", seed: int = 42, **cols):
    return DecisionTreeClassifier(
        maxDepth=DEEPEST if max_depth is None else max_depth, minInstancesPerNode=min_leaf, impurity=criterion, seed=seed, **cols
    )


def forest_classifier(trees: int = 100, max_depth: int | None = None, min_leaf: int = 1, seed: int = 42, **cols):
    """Forest with the square root of the features tried per split."""
    return RandomForestClassifier(
        numTrees=trees, maxDepth=DEEPEST if max_depth is None else max_depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="sqrt", seed=seed, **cols,
    )


def forest_regressor(trees: int = 100, max_depth: int | None = None, min_leaf: int = 1, seed: int = 42, **cols):
    """Forest with all features tried per split."""
    return RandomForestRegressor(
        numTrees=trees, maxDepth=DEEPEST if max_depth is None else max_depth, minInstancesPerNode=min_leaf,
        featureSubsetStrategy="all", seed=seed, **cols,
    )


def gbt_classifier(rounds: int = 100, max_depth: int = 3, rate: float = 0.1, seed: int = 42, **cols):
    return GBTClassifier(maxIter=rounds, maxDepth=max_depth, stepSize=rate, seed=seed, **cols)


# Rows whose values Spark's trees choose their split points from, at least.
_SPLIT_ROWS = 10_000


class BinnedGBTRegressor(GBTRegressor):
    """Boosted trees on a row for each cell of the bins: the same trees, and no pass over the rows for a round.

    Trees see of a row no more than the bins its features lie in, and the squared error splits rows by the sums and
    counts of their labels.  So rows in the same bins are one row with their mean label and their number as weight.
    Split points are chosen as Spark's trees do, from the same rows.  With options for which that does not hold
    (another loss, weights, samples, least numbers of rows) the rows themselves are fitted.
    """

    def _fit(self, dataset):
        plain = self.getLossType() == "squared" and self.getSubsamplingRate() == 1.0 and self.getMinInstancesPerNode() == 1
        plain = plain and self.getMinWeightFractionPerNode() == 0.0 and self.getMinInfoGain() == 0.0
        if not plain or self.isDefined(self.weightCol) or self.isDefined(self.validationIndicatorCol) or _has_levels(dataset, self.getFeaturesCol()):
            return super()._fit(dataset)
        cells, splits, sound = self.cells(dataset)
        groups = cells.count() if sound else 0
        if not groups:
            # Its own message on labels that are missing, or no rows.
            return super()._fit(dataset)
        # All cells serve to find the bounds of the bins again.
        inner = GBTRegressor(featuresCol="features", labelCol="label", weightCol="n", maxIter=self.getMaxIter(), maxDepth=self.getMaxDepth())
        inner._set(stepSize=self.getStepSize(), seed=self.getSeed(), maxBins=max(self.getMaxBins(), int(groups**0.5) + 1))
        inner._set(featureSubsetStrategy=self.getFeatureSubsetStrategy(), maxMemoryInMB=self.getMaxMemoryInMB())
        inner._set(cacheNodeIds=self.getCacheNodeIds(), checkpointInterval=self.getCheckpointInterval())
        model = inner.fit(cells)
        cells.unpersist()
        return self._copyValues(_with_splits(model, splits, self.uid))

    def cells(self, dataset) -> tuple[DataFrame, list[list[float]], bool]:
        """``(features, label, n)`` for each cell, kept; the split points of every feature; whether all labels are there."""
        label = F.col(self.getLabelCol()).cast("double")
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), label.alias("y"))
        splits = _split_points(rows.select("x"), self.getMaxBins(), self.getSeed())
        codes = [_bin(F.col("x")[i], points).alias(f"c{i}") for i, points in enumerate(splits)]
        found = rows.select(*codes, "y").groupBy(*[f"c{i}" for i in range(len(splits))])
        missing = F.col("y").isNull() | F.isnan("y")
        found = found.agg(F.avg("y").alias("label"), F.count(F.lit(1)).cast("double").alias("n"), F.count_if(missing).alias("missing"))
        x = array_to_vector(F.array(*[F.col(f"c{i}").cast("double") for i in range(len(splits))]).cast("array<double>"))
        cells = found.select(x.alias("features"), "label", "n", "missing").persist()
        sound = not (cells.agg(F.sum("missing").alias("m")).first()["m"] or 0)
        return cells.drop("missing"), splits, sound


def _has_levels(dataset: DataFrame, col: str) -> bool:
    """Whether the assembler has marked features as texts' numbers; trees take those one by one."""
    attributes = dataset.schema[col].metadata.get("ml_attr", {}).get("attrs", {})
    return any(kind in attributes for kind in ("nominal", "binary"))


def _split_points(rows: DataFrame, max_bins: int, seed: int) -> list[list[float]]:
    """Split points of every element of ``x``, from the rows that Spark's trees take and in their way."""
    spark, total = rows.sparkSession, rows.count()
    wanted = max(max_bins * max_bins, _SPLIT_ROWS)
    if wanted < total:
        # The trees' own sample, of about ``wanted`` rows.
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sampled = rows._jdf.javaRDD().sample(False, wanted / total, draw)
        rows = DataFrame(spark._jsparkSession.createDataFrame(sampled, rows._jdf.schema()), spark)
    held = [r["x"] for r in rows.collect()]
    if not held:
        return []
    expected = wanted / total * total if wanted < total else float(total)
    return [_points(np.array(values), min(max_bins, total) - 1, expected) for values in zip(*held)]


def _points(values: np.ndarray, most: int, expected: float) -> list[float]:
    """Split points of one feature: between all neighbouring values, or at about equal numbers of rows."""
    # Zeros are what is left of the number of rows expected.
    known, counts = np.unique(values[values != 0.0], return_counts=True)
    zeros = expected - counts.sum()
    if zeros > np.finfo(np.float64).eps * len(values) ** 2:
        at = int(np.searchsorted(known, 0.0))
        known, counts = np.insert(known, at, 0.0), np.insert(counts.astype(float), at, zeros)
    if len(known) - 1 <= most:
        return ((known[1:] + known[:-1]) / 2.0).tolist()
    out, target, now = [], expected / (most + 1), float(counts[0])
    for i in range(1, len(known)):
        before, now = now, now + float(counts[i])
        if abs(before - target) < abs(now - target):
            out.append(float((known[i - 1] + known[i]) / 2.0))
            target += expected / (most + 1)
    return out


def _bin(x: Column, points: list[float], low: int = 0, high: int | None = None) -> Column:
    """The number of split points below ``x``, by halves."""
    high = len(points) if high is None else high
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(x <= F.lit(points[middle]), _bin(x, points, low, middle)).otherwise(_bin(x, points, middle + 1, high))


def _with_splits(model: GBTRegressionModel, splits: list[list[float]], uid: str) -> GBTRegressionModel:
    """A model fitted on numbers of bins as one on the values themselves."""
    jvm, java = SparkContext._active_spark_context._jvm, model._java_obj
    ml = jvm.org.apache.spark.ml

    def moved(node):
        if node.getClass().getSimpleName() == "LeafNode":
            return node
        at = node.split().featureIndex()
        split = ml.tree.ContinuousSplit(at, float(splits[at][int(node.split().threshold())]))
        return ml.tree.InternalNode(
            node.prediction(), node.impurity(), node.gain(), moved(node.leftChild()), moved(node.rightChild()), split, node.impurityStats()
        )

    gateway, trees, kind = SparkContext._gateway, java.trees(), ml.regression.DecisionTreeRegressionModel
    new, weights = gateway.new_array(kind, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, java.treeWeights())):
        new[i], weights[i] = kind(tree.uid(), moved(tree.rootNode()), len(splits)), weight
    return GBTRegressionModel(ml.regression.GBTRegressionModel(uid, new, weights, len(splits)))


def gbt_regressor(rounds: int = 100, max_depth: int = 3, rate: float = 0.1, seed: int = 42, **cols):
    return BinnedGBTRegressor(maxIter=rounds, maxDepth=max_depth, stepSize=rate, seed=seed, **cols)


class KernelSVM(Estimator):
    """Radial-kernel support vector machine on random cosine features: an approximation.

    The kernel map is a seeded SQL projection of numeric columns, then one linear machine per
    class (one in all for two classes), then a logistic fit on the margins for probabilities.
    ``gamma=None`` is one over features times variance.  ``C``, ``gamma``, ``width`` and ``seed``
    are parameters that a search can vary.
    """

    C = Param(Params._dummy(), "C", "weight of the errors", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "number of cosine features", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the features", TypeConverters.toInt)

    def __init__(self, cols: list[str], label: str, C: float = 1.0, gamma: float | None = None, width: int = 100, seed: int = 42):
        super().__init__()
        self.cols, self.label = list(cols), label
        self._set(C=C, gamma=gamma, width=width, seed=seed)

    def _fit(self, dataset):
        C, width = self.getOrDefault(self.C), self.getOrDefault(self.width)
        gamma = self.getOrDefault(self.gamma) or 1.0 / (len(self.cols) * self._spread(dataset))
        rng = np.random.default_rng(self.getOrDefault(self.seed))
        w = rng.normal(scale=np.sqrt(2.0 * gamma), size=(width, len(self.cols)))
        b = rng.uniform(0.0, 2.0 * np.pi, width)
        terms = [
            f"cos({' + '.join(f'({float(v)!r}D) * `{c}`' for v, c in zip(row, self.cols))} + {float(o)!r}D) AS __k{i}"
            for i, (row, o) in enumerate(zip(w, b))
        ]
        kernel = PipelineModel([
            SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__"),
            VectorAssembler(inputCols=[f"__k{i}" for i in range(width)], outputCol="__kernel"),
        ])
        # A table in one piece would be one task with all features; the rows are spread while they are narrow.
        parts = -(-dataset.count() * (width + 2) * 8 // TASK_BYTES)
        narrow = dataset.select(*self.cols, self.label)
        if narrow.rdd.getNumPartitions() < parts:
            narrow = narrow.repartition(parts)
        mapped = kernel.transform(narrow).select("__kernel", self.label).persist()
        size = mapped.agg(F.count(F.lit(1)).alias("n"), F.max(self.label).alias("last")).first()
        machine = LinearSVC(
            regParam=1.0 / (C * size["n"]), tol=1e-3, featuresCol="__kernel", labelCol=self.label, predictionCol="__class"
        )
        if size["last"] > 1:
            machine = OneVsRest(classifier=machine, featuresCol="__kernel", labelCol=self.label, predictionCol="__class")
        margins = machine.fit(mapped)
        calibrated = LogisticRegression(
            featuresCol="rawPrediction", labelCol=self.label, rawPredictionCol="__calibrated"
        ).fit(margins.transform(mapped))
        mapped.unpersist()
        return PipelineModel([kernel, margins, calibrated])

    def _spread(self, dataset):
        """Variance of all values of all columns, from one row of moments per column."""
        moments = dataset.agg(*[f(F.col(c).cast("double")) for c in self.cols for f in (F.count, F.avg, F.var_pop)]).first()
        n, mean, var = (np.array([x or 0.0 for x in moments[i::3]], dtype=float) for i in range(3))
        middle = (n * mean).sum() / max(n.sum(), 1.0)
        return (n * (var + (mean - middle) ** 2)).sum() / max(n.sum(), 1.0) or 1.0


def importance(model: Transformer, names: list[str]) -> DataFrame:
    """``(feature, importance)`` above zero, largest first.

    Trees report split importances; linear models the mean absolute coefficient over classes.
    ``names`` is the assembler's input list, so names and positions cannot drift apart.
    """
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        values = np.abs(model.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(names, values) if v > 0]
    return _local(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def coefficients(model: Transformer, names: list[str]) -> DataFrame:
    """``(class, term, value)`` with the intercept as a term."""
    if hasattr(model, "coefficientMatrix"):
        table, offsets = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    else:
        table, offsets = model.coefficients.toArray()[None, :], np.array([model.intercept])
    rows = []
    for c, (row, offset) in enumerate(zip(table, offsets)):
        rows += [(c, n, float(v)) for n, v in zip(names, row)] + [(c, "intercept", float(offset))]
    return _local(rows, "class int, term string, value double")


def nonzero_count(coefs: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Number of coefficients that are not zero, the intercept left out."""
    return coefs.where(F.col("term") != "intercept").agg(F.count_if(F.abs("value") > tolerance).alias("nonzero"))


def _local(rows, schema):
    from pyspark.sql import SparkSession

    return SparkSession.active().createDataFrame(rows, schema)


def score(model: Transformer, df: DataFrame, keep: list[str], classes: int = 0) -> DataFrame:
    """Predictions, and class probabilities ``p0`` .. when ``classes`` is given."""
    out = model.transform(df)
    if not classes:
        return out.select(*keep, "prediction")
    p = vector_to_array("probability")
    return out.select(*keep, "prediction", *[p[i].alias(f"p{i}") for i in range(classes)])


def compare_datasets(estimators: dict, datasets: dict, evaluate) -> DataFrame:
    """Train every model on every data set: long ``(model, dataset, metric, value)``.

    ``datasets`` maps a name to ``(train, test)``; ``evaluate(predictions)`` gives one row of
    metrics.
    """
    from .metrics import metrics_long

    out = None
    for dataset, (train, test) in datasets.items():
        for name, estimator in estimators.items():
            rows = metrics_long(evaluate(estimator.fit(train).transform(test)), name, dataset)
            out = rows if out is None else out.unionByName(rows)
    return out
