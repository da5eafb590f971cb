"""Boosted trees on cells of bins against Spark's on the rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from calibra.operators import models as M


def table(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n) * 0.25, rng.exponential(size=n) * rng.integers(0, 2, n)])
    y = np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 2] + rng.normal(0, 0.3, n)
    rows = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)


@pytest.mark.parametrize("n", [3000, 25000])
def test_same_trees_from_cells_as_from_rows(spark, n):
    """With more rows than split points are chosen from, too."""
    df = table(spark, n).repartition(4, "a").sortWithinPartitions("a", "c").persist()
    plain = GBTRegressor(maxIter=4, maxDepth=3, stepSize=0.1, seed=42).fit(df)
    estimator = M.gbt_regressor(rounds=4, max_depth=3)
    model = estimator.fit(df)
    want, got = ([r[0] for r in m.transform(df).select("prediction").collect()] for m in (plain, model))
    assert got == pytest.approx(want, rel=1e-9)
    assert model.getNumTrees == 4 and list(model.treeWeights) == list(plain.treeWeights)
    cells, splits, sound = estimator.cells(df)
    # As many rows for a round as there are cells that hold any, however many rows the table has.
    assert sound and cells.count() <= 33 * 5 * 33 and cells.agg(F.sum("n")).first()[0] == n
    assert 30 <= len(splits[0]) <= 33 and splits[1] == pytest.approx([0.125, 0.375, 0.625, 0.875])


def test_missing_labels_still_fail(spark):
    df = table(spark, 50).withColumn("label", F.when(F.col("a") > 0, F.col("label")))
    with pytest.raises(Exception, match="(?i)label"):
        M.gbt_regressor(rounds=2).fit(df)
