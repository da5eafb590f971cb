"""Label quality: comparison of labels with clusters and neighbour consensus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.blocks import ROWS_PER_BLOCK
from ..functions.ordering import with_position
from ..functions.sizing import TASK_ROWS, cut_lineage
from .density import NOISE
from .metrics import ari
from .neighbors import knn, votes

# Upper ends of the score bands.
CORE_BELOW, BORDER_BELOW = 0.05, 0.20


def outlier_bands(scores: DataFrame, group: str) -> DataFrame:
    """Counts of core, border and outlier scores of the rows with ``group``, and both mean scores."""
    chosen = F.col(group)
    s = F.col("score")
    return scores.agg(
        F.avg("score").alias("global_mean"),
        F.avg(F.when(chosen, s)).alias("group_mean"),
        F.count_if(chosen & (s < CORE_BELOW)).alias("core"),
        F.count_if(chosen & (s >= CORE_BELOW) & (s < BORDER_BELOW)).alias("border"),
        F.count_if(chosen & (s >= BORDER_BELOW)).alias("outlier"),
    )


def mislabeled(aligned: DataFrame, label: str) -> DataFrame:
    """Rows labelled 1 that lie in the cluster of class 0."""
    return aligned.where((F.col(label) == 1) & (F.col("cluster") == 0))


def mislabel_report(aligned: DataFrame, label: str) -> DataFrame:
    """Counts and shares of confirmed and reclassified rows among those labelled 1."""
    ones = aligned.where(F.col(label) == 1).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("cluster") == 1).alias("confirmed"),
    )
    ones = ones.withColumn("reclassified", F.col("total") - F.col("confirmed"))
    return ones.withColumns(
        {f"{c}_percent": F.try_divide(100.0 * F.col(c), F.col("total")) for c in ("confirmed", "reclassified")}
    )


def cluster_feature_diff(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    """``(feature, difference)``: absolute difference of the means of clusters 0 and 1, largest first."""
    one, zero = F.col(cluster) == 1, F.col(cluster) == 0
    wide = df.agg(*[F.abs(F.avg(F.when(one, F.col(c))) - F.avg(F.when(zero, F.col(c)))).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "difference").orderBy(F.desc("difference"), "feature")


def stability(
    df: DataFrame, key: str, reference: DataFrame, fit: Callable[[DataFrame, int], DataFrame], rounds: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """``(summary, per round)`` of the ARI between reference labels and a refit on a resample.

    ``fit(sample, seed)`` returns ``(key, cluster)`` for the rows of the sample, keyed by ``key``;
    drawn copies get keys of their own (``key`` and a copy number are kept apart in ``__draw``).
    """
    values = None
    for i in range(rounds):
        drawn = df.sample(True, 1.0, seed + i)
        drawn = cut_lineage(drawn.withColumn("__of", F.col(key)).withColumn(key, F.monotonically_increasing_id()))
        refit = fit(drawn.drop("__of"), seed + i)
        both = drawn.select(key, F.col("__of")).join(refit.withColumnRenamed("cluster", "__new"), key)
        both = both.join(reference.select(F.col(key).alias("__of"), F.col("cluster").alias("__ref")), "__of")
        one = ari(both, "__ref", "__new").withColumn("round", F.lit(i))
        values = one if values is None else values.unionByName(one)
    values = cut_lineage(values)
    return values.agg(F.avg("ari").alias("mean"), F.stddev_pop("ari").alias("std"), F.count(F.lit(1)).alias("rounds")), values


def consensus(
    df: DataFrame, key: str, features: str, label: str, k: int = 11, include_self: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK, search=knn,
) -> DataFrame:
    """``(key, label, predicted, uncertainty)`` by a distance-weighted vote of the neighbours that ``search`` finds."""
    near = search(df, key, features, k, include_self=include_self, payload=[label], rows_per_block=rows_per_block)
    voted = votes(near, key, label, "distance")
    return df.select(key, label).join(voted, key).select(
        key, label, "predicted", (1 - F.col("confidence")).alias("uncertainty")
    )


def relabel(
    df: DataFrame, key: str, features: str, label: str, k: int = 11, cap: float = 0.30, include_self: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK, task_rows: int = TASK_ROWS, search=knn,
) -> DataFrame:
    """``(key, label, predicted, uncertainty, relabeled, clean)``.

    Among the rows that disagree with their neighbours the most uncertain ones take the
    neighbours' label, at most ``floor(cap * rows)`` of them.  ``include_self`` lets each row vote
    for itself at distance 0, which leaves nothing to relabel unless rows coincide.
    """
    judged = cut_lineage(consensus(df, key, features, label, k, include_self, rows_per_block, search))
    limit = int(judged.count() * cap)
    apart = judged.where(F.col(label) != F.col("predicted")).withColumn("__u", -F.col("uncertainty"))
    chosen = with_position(apart.select(key, "__u"), ["__u", key], name="__at", task_rows=task_rows)
    chosen = chosen.where(F.col("__at") < limit).select(key, F.lit(True).alias("__hit"))
    marked = judged.join(chosen, key, "left").withColumn("relabeled", F.coalesce("__hit", F.lit(False))).drop("__hit")
    return marked.withColumn("clean", F.when(F.col("relabeled"), F.col("predicted")).otherwise(F.col(label)))


def relabel_summary(relabeled: DataFrame, label: str, cap: float = 0.30) -> DataFrame:
    """Alignment with the neighbours, disagreement and relabelled counts in one row; ``cap`` as in :func:`relabel`."""
    apart = F.col(label) != F.col("predicted")
    return relabeled.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((~apart).cast("int")).alias("alignment"),
        F.count_if(apart).alias("disagree"),
        F.count_if("relabeled").alias("relabeled"),
    ).withColumn("max_relabel", F.floor(F.col("rows") * cap))


def balance(df: DataFrame, versions: dict[str, str]) -> DataFrame:
    """``(version, class, n)``: class counts of several label columns in one pass."""
    cells = F.array(*[F.struct(F.lit(v).alias("version"), F.col(c).cast("string").alias("class")) for v, c in versions.items()])
    return df.select(F.inline(cells)).groupBy("version", "class").agg(F.count(F.lit(1)).alias("n"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``(cluster, n)``, noise as -1."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def cluster_summary(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Number of clusters (noise not counted) and number of noise rows."""
    c = F.col(cluster)
    return df.agg(F.count_distinct(F.when(c != NOISE, c)).alias("clusters"), F.count_if(c == NOISE).alias("noise"))


def rank_methods(scores: DataFrame) -> DataFrame:
    """``(method, silhouette)`` with the best first."""
    return scores.orderBy(F.desc_nulls_last("silhouette"), "method")
