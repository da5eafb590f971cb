"""Evaluation of predictions and clusterings.  All class metrics come from one confusion count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import with_running_total
from ..functions.sizing import TASK_ROWS, bounded_rows
from ..functions.vectors import nearest_center


def confusion_counts(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """``(*by, y, p, n)`` with classes as text."""
    return df.groupBy(*by, F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )


def accuracy(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("int")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def _zero_safe(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _scores(tp: Column, predicted: Column, support: Column) -> dict[str, Column]:
    """Precision, recall and F1 where an empty denominator counts as zero."""
    return {
        "precision": _zero_safe(tp.cast("double"), predicted.cast("double")),
        "recall": _zero_safe(tp.cast("double"), support.cast("double")),
        "f1": _zero_safe(2.0 * tp, (predicted + support).cast("double")),
    }


def prf_binary(df: DataFrame, label: str, prediction: str, positive=1, by: list[str] = ()) -> DataFrame:
    """Precision, recall and F1 of the positive class."""
    y, p = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    sums = df.groupBy(*by).agg(F.count_if(y & p).alias("tp"), F.count_if(p).alias("pp"), F.count_if(y).alias("ap"))
    scores = _scores(F.col("tp"), F.col("pp"), F.col("ap"))
    return sums.select(*by, *[e.alias(n) for n, e in scores.items()])


def class_scores(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """``(*by, class, precision, recall, f1, support)``."""
    by = list(by)
    counts = confusion_counts(df, label, prediction, by)
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("y").alias("class"), hit.alias("tp"), zero.alias("predicted"), F.col("n").alias("support")),
        F.struct(F.col("p").alias("class"), zero.alias("tp"), F.col("n").alias("predicted"), zero.alias("support")),
    )
    sums = (
        counts.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support"))
    )
    scores = _scores(F.col("tp"), F.col("predicted"), F.col("support"))
    return sums.select(*by, "class", *[e.alias(n) for n, e in scores.items()], "support")


def _averaged(scores: DataFrame, by: list[str], rows: Column) -> DataFrame:
    """Weighted means of the class scores; ``rows`` lists ``struct(name, w)`` for each class."""
    measures = ["precision", "recall", "f1"]
    spread = scores.select(*by, *measures, "support", F.inline(rows))
    mean = {m: _zero_safe(F.sum(F.col(m) * F.col("w")), F.sum("w")).alias(m) for m in measures}
    return spread.groupBy(*by, "name").agg(*mean.values(), F.sum("support").alias("support"))


def prf_weighted(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """Precision, recall and F1 averaged with the class supports as weights."""
    row = F.array(F.struct(F.lit("weighted").alias("name"), F.col("support").cast("double").alias("w")))
    return _averaged(class_scores(df, label, prediction, by), list(by), row).select(*by, "precision", "recall", "f1")


def report(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """Scores per class, their macro and support-weighted means, from one pass over the rows."""
    one, share = F.lit(1.0), F.col("support").cast("double")
    rows = F.array(
        F.struct(F.col("class").alias("name"), one.alias("w")),
        F.struct(F.lit("macro avg").alias("name"), one.alias("w")),
        F.struct(F.lit("weighted avg").alias("name"), share.alias("w")),
    )
    return _averaged(class_scores(df, label, prediction, by), list(by), rows)


def confusion(df: DataFrame, label: str, prediction: str, classes: list[str] | None = None, max_classes: int = 1000) -> DataFrame:
    """Square confusion matrix with every class as row and column, empty cells zero."""
    counts = confusion_counts(df, label, prediction)
    if classes is None:
        seen = counts.select(F.explode(F.array("y", "p")).alias("c")).where("c is not null").distinct()
        classes = sorted(r[0] for r in bounded_rows(seen, max_classes, "classes"))
    rows = df.sparkSession.createDataFrame([(c,) for c in classes], "y string")
    wide = counts.groupBy("y").pivot("p", classes).agg(F.sum("n"))
    return rows.join(wide, "y", "left").na.fill(0).withColumnRenamed("y", "actual")


def auc_by_class(df: DataFrame, label: str, scores: dict, task_rows: int = TASK_ROWS) -> DataFrame:
    """One-vs-rest ``(class, auc, support)``: the rank statistic with half weight for ties.

    Rows are first counted per distinct score, then a distributed running total gives the
    negatives below each score.
    """
    cells = [
        F.struct(F.lit(str(c)).alias("class"), s.cast("double").alias("score"), (F.col(label) == F.lit(c)).cast("bigint").alias("hit"))
        for c, s in scores.items()
    ]
    per_score = (
        df.select(F.inline(F.array(*cells)))
        .groupBy("class", "score")
        .agg(F.sum("hit").alias("pos"), (F.count(F.lit(1)) - F.sum("hit")).alias("neg"))
    )
    ranked = with_running_total(per_score, {"neg_below": "neg"}, ["score"], ["class"], task_rows)
    wins = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    return ranked.groupBy("class").agg(
        F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.sum("pos").alias("support"),
    )


def auc_ovr(df: DataFrame, label: str, scores: dict, task_rows: int = TASK_ROWS) -> DataFrame:
    """Macro and support-weighted mean of the one-vs-rest areas."""
    per = auc_by_class(df, label, scores, task_rows)
    weighted = F.sum(F.col("auc") * F.col("support")) / F.sum("support")
    return per.agg(F.avg("auc").alias("macro"), weighted.alias("weighted"))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """R2, MAE and RMSE in one aggregate."""
    e = F.col(label) - F.col(prediction)
    total = F.count(e) * F.var_pop(label)
    return df.groupBy(*by).agg(
        (1 - F.try_divide(F.sum(e * e), total)).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
    )


def split_metrics(df: DataFrame, label: str, prediction: str, part: str = "part") -> DataFrame:
    """Weighted class scores and accuracy side by side for each part of a split."""
    return prf_weighted(df, label, prediction, [part]).join(accuracy(df, label, prediction, [part]), part)


def real_vs_pred(df: DataFrame, key: list[str], label: str, prediction: str) -> DataFrame:
    """Real and predicted values with the common axis limits."""
    low, high = F.least(F.min(label), F.min(prediction)), F.greatest(F.max(label), F.max(prediction))
    limits = df.agg(F.struct(low.alias("low"), high.alias("high")).alias("s")).scalar()
    return df.select(
        *key, F.col(label).alias("real"), F.col(prediction).alias("predicted"),
        limits["low"].alias("low"), limits["high"].alias("high"),
    )


def metric_pivot(df: DataFrame, metric: str, datasets: list[str]) -> DataFrame:
    """From long ``(model, dataset, metric, value)`` rows: one row per model, one column per data set."""
    return df.where(F.col("metric") == metric).groupBy("model").pivot("dataset", datasets).agg(F.first("value"))


def metrics_long(wide: DataFrame, model: str, dataset: str) -> DataFrame:
    """One metrics row as long ``(model, dataset, metric, value)`` rows."""
    return wide.select(F.lit(model).alias("model"), F.lit(dataset).alias("dataset"), *wide.columns).unpivot(
        ["model", "dataset"], wide.columns, "metric", "value"
    )


def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings, from one contingency count."""
    cells = df.groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(None).cast("string")
    margins = F.array(
        F.struct(F.lit("cell").alias("kind"), F.col("a").alias("x"), F.col("b").alias("y"), F.col("n")),
        F.struct(F.lit("row").alias("kind"), F.col("a").alias("x"), none.alias("y"), F.col("n")),
        F.struct(F.lit("col").alias("kind"), none.alias("x"), F.col("b").alias("y"), F.col("n")),
        F.struct(F.lit("all").alias("kind"), none.alias("x"), none.alias("y"), F.col("n")),
    )
    sums = cells.select(F.inline(margins)).groupBy("kind", "x", "y").agg(F.sum("n").cast("double").alias("n"))
    pairs = F.col("n") * (F.col("n") - 1) / 2
    row = sums.agg(*[F.sum(F.when(F.col("kind") == k, pairs)).alias(f"s_{k}") for k in ("cell", "row", "col", "all")])
    expected = F.coalesce(F.try_divide(F.col("s_row") * F.col("s_col"), F.col("s_all")), F.lit(0.0))
    best = (F.col("s_row") + F.col("s_col")) / 2
    return row.select(F.coalesce(F.try_divide(F.col("s_cell") - expected, best - expected), F.lit(1.0)).alias("ari"))


def inertia(df: DataFrame, features: str, centers) -> DataFrame:
    """Sum of squared distances to the nearest of the given centers."""
    return df.agg(F.sum(nearest_center(features, centers)["sq"]).alias("inertia"))
