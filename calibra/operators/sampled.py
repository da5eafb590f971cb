"""Silhouette from a stratified sample of points against all points, with its standard error."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.blocks import ROWS_PER_BLOCK, Blocks, as_points, collapse
from ..functions.sizing import bounded_rows, cut_lineage
from ..functions.vectors import matrix, sq_distances
from .density import NOISE
from .neighbors import point_scores

PER_CLUSTER, MAX_SAMPLE, LOTS, SEED = 200, 50_000, 64, 42


def _in_blocks(points: DataFrame, taken: DataFrame | None, key: str, rows_per_block: int) -> DataFrame:
    """The estimate from a sample of any size, or from all points."""

    def distinct(frame):
        return collapse(frame.select(key, "x", F.array("l").alias("ls")), key, ["ls"])

    blocks = Blocks.build(distinct(points), rows_per_block)
    scores, sizes = point_scores(blocks, 1, None if taken is None else blocks.queries(distinct(taken)))
    w, s = F.col("w"), F.col("score")
    by = scores.groupBy(F.col("own").alias("cluster")).agg(F.sum(w).alias("m"), F.sum(w * s).alias("s"), F.sum(w * s * s).alias("q"))
    var = F.greatest(F.try_divide(F.col("q") - F.col("s") * F.col("s") / F.col("m"), F.col("m") - 1), F.lit(0.0))
    by = by.join(sizes.drop("at"), "cluster").withColumn("v", F.coalesce(var, F.lit(0.0)) / F.col("m") * (1 - F.col("m") / F.col("n")))
    total = F.sum("n").cast("double")
    return by.agg(
        F.count(F.lit(1)).cast("int").alias("clusters"),
        F.sum("n").alias("points"),
        F.sum("m").alias("sampled"),
        (F.sum(F.col("n") * F.col("s") / F.col("m")) / total).alias("silhouette"),
        (F.sqrt(F.sum(F.col("n").cast("double") * F.col("n") * F.col("v"))) / total).alias("error"),
    )


def silhouette_sampled(
    df: DataFrame, key: str, features: str, label: str, per_cluster: int | None = PER_CLUSTER, seed: int = SEED,
    max_sample: int = MAX_SAMPLE, rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """``(clusters, points, sampled, silhouette, error)``: an estimate of :func:`neighbors.silhouette`.

    Of every cluster the ``per_cluster`` rows with the smallest tickets (a hash of key and seed) are
    compared with all rows, so the work grows with the rows and not with their square.  Clusters count
    by their size.  ``per_cluster=None`` takes every row.  ``error`` is the standard error of the estimate, 0 where every row is in the sample.
    Rows of the noise label -1 and without label or features take no part; with fewer than two clusters the
    silhouette is null.  A sample of more than ``max_sample`` rows, or of every row, stays with the executors and meets
    all rows in blocks.
    """
    points = as_points(df, key, features, [F.col(label).cast("int").alias("l")])
    points = cut_lineage(points.where(F.col("l").isNotNull() & (F.col("l") != NOISE) & F.col("x").isNotNull()))
    counted = points.groupBy("l").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") if per_cluster is None else F.least("n", F.lit(per_cluster))
    held = counted.agg(F.count(F.lit(1)).alias("clusters"), F.sum(share).alias("rows")).first()
    first = Window.partitionBy("l").orderBy(F.xxhash64(key, F.lit(seed)), key)
    taken = points
    if per_cluster is not None:
        taken = points.withColumn("__at", F.row_number().over(first)).where(F.col("__at") <= per_cluster).drop("__at")
    if held["clusters"] > 1 and (per_cluster is None or held["rows"] > max_sample):
        return _in_blocks(points, None if per_cluster is None else taken, key, rows_per_block)
    sizes = {r["l"]: r["n"] for r in bounded_rows(counted, max_sample, "clusters")}
    sample = sorted(bounded_rows(taken.select(key, "x", "l"), max_sample, "rows of the sample"), key=lambda r: (r["l"], r[key]))
    schema = "clusters int, points bigint, sampled bigint, silhouette double, error double"
    if len(sizes) < 2:
        return points.sparkSession.createDataFrame([(len(sizes), sum(sizes.values()), len(sample), None, None)], schema)
    names, own = np.unique([r["l"] for r in sample], return_inverse=True)
    shared = points.sparkSession.sparkContext.broadcast(np.array([r["x"] for r in sample], dtype=np.float64))

    def distances(frames):
        total = np.zeros((len(sample), len(names)))
        for frame in frames:
            at = np.searchsorted(names, frame["l"].to_numpy())
            member = np.zeros((len(frame), len(names)))
            member[np.arange(len(frame)), at] = 1.0
            total += np.sqrt(sq_distances(shared.value, matrix(frame["x"]))) @ member
        yield pd.DataFrame({"total": [total.tobytes()]})

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lot": [0], "total": [sum(np.frombuffer(b) for b in frame["total"]).tobytes()]})

    parts = points.select("x", "l").mapInPandas(distances, "total binary").withColumn("lot", F.pmod(F.spark_partition_id(), F.lit(LOTS)))
    lots = parts.groupBy("lot").applyInPandas(add, "lot int, total binary")
    # One row of a number for each point of the sample and cluster.
    total = np.frombuffer(lots.groupBy("lot").applyInPandas(add, "lot int, total binary").first()["total"]).reshape(len(sample), len(names))
    n = np.array([sizes[c] for c in names.tolist()], dtype=np.float64)
    mine = np.arange(len(names))[None, :] == own[:, None]
    a = total[mine] / np.maximum(n[own] - 1, 1)
    b = np.where(mine, np.inf, total / n[None, :]).min(axis=1)
    most = np.maximum(a, b)
    score = np.where((n[own] > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1.0), 0.0)
    mean = error = 0.0
    for h in range(len(names)):
        s, share = score[own == h], n[h] / n.sum()
        mean += share * s.mean()
        if len(s) > 1:
            error += share**2 * s.var(ddof=1) / len(s) * (1 - len(s) / n[h])
    row = (len(names), int(n.sum()), len(sample), float(mean), float(np.sqrt(error)))
    return points.sparkSession.createDataFrame([row], schema)
