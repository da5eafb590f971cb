"""Lots of blocks: a point travels a bounded number of times, and results are those of brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from calibra.functions import blocks as B, vectors as V
from calibra.operators import density, hierarchy, lsh, models, neighbors, sampled, starts


def frame(spark, x, labels=None):
    rows = [(i, [float(v) for v in p], int(labels[i]) if labels is not None else 0) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, x array<double>, label int")


def brute(x, label):
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = np.zeros(len(x))
    for i in range(len(x)):
        means = {c: dist[i, label == c].sum() / ((label == c).sum() - (c == label[i])) for c in set(label.tolist()) if c != label[i] or (label == c).sum() > 1}
        if label[i] in means:
            a, b = means[label[i]], min(v for c, v in means.items() if c != label[i])
            out[i] = (b - a) / max(a, b)
    return out


@pytest.mark.parametrize(("total", "rows"), [(10_000, 10), (1_000_000, 2048), (500, 2048)])
def test_a_point_travels_a_dozen_times_until_lots_are_full(total, rows):
    counts = np.random.default_rng(1).multinomial(total, np.ones(40) / 40)
    pivots = np.random.default_rng(2).normal(size=(40, 3))
    first, parts = B._lots(counts, pivots, B.lot_rows(total, rows))
    assert (first + parts).max() <= max(B.LOTS, -(-total // B.MAX_LOT_ROWS)) + 1
    whole, cut = B._lots(np.array([total]), np.empty((0, 0)), B.lot_rows(total, rows))
    assert whole[0] == 0 and cut[0] <= max(B.LOTS, -(-total // B.MAX_LOT_ROWS))


def test_silhouette_of_many_clusters(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(150, 3)), 3)
    label = np.where(np.arange(150) < 60, 0, np.arange(150) // 3)
    df = frame(spark, x, label)
    for few in (2, 100):
        row = neighbors.silhouettes(df, "id", "x", ["label"], 20, few).first()
        assert row["silhouette"] == pytest.approx(brute(x, label).mean(), abs=1e-9) and row["clusters"] == len(set(label))


def test_far_cells_do_not_meet_in_the_tree(spark):
    x = np.array([[g * 1000.0, p * 0.1] for g in range(40) for p in range(10)])
    nodes = frame(spark, x).withColumn("core", F.lit(0.0)).withColumn("node", F.col("id"))
    blocks = B.Blocks.build(nodes, 5)
    assert hierarchy._needed(blocks).mean() < 0.5
    tree = hierarchy.spanning_tree(frame(spark, x), "id", "x", 1, 5).collect()
    assert len(tree) == 399 and sum(r["weight"] for r in tree) == pytest.approx(39 * 1000 + 360 * 0.1)


def test_sparse_groups_as_dense():
    rng = np.random.default_rng(5)
    for share in (0.0, 0.01, 0.04, 0.1):
        mask = rng.random((50, 40)) < share
        left, right = density._sparse_groups(mask)
        rows, cols = mask.shape
        want = np.where(mask.any(axis=1), np.arange(rows), rows)
        for _ in range(rows):
            other = np.where(mask, want[:, None], rows).min(axis=0)
            want = np.minimum(want, np.where(mask, other[None, :], rows).min(axis=1))
        assert (left == np.where(want == rows, -1, want)).all() and (right == np.where(other == rows, -1, other)).all()


def test_sample_too_large_for_the_driver(spark):
    rng = np.random.default_rng(4)
    x, label = np.round(rng.normal(size=(120, 3)), 3), rng.integers(0, 3, 120)
    df = frame(spark, x, label)
    row = sampled.silhouette_sampled(df, "id", "x", "label", per_cluster=None, rows_per_block=25).first()
    assert (row["points"], row["sampled"], row["error"]) == (120, 120, 0.0) and row["silhouette"] == pytest.approx(brute(x, label).mean(), abs=1e-9)
    large, small = (sampled.silhouette_sampled(df, "id", "x", "label", 15, max_sample=m, rows_per_block=25).first() for m in (20, 1000))
    assert tuple(large) == pytest.approx(tuple(small))


def test_boxes_of_points_on_a_line_stay_small(spark):
    x = np.array([[float(i), 0.0] for i in range(3000)])
    df = frame(spark, x)
    boxes = lsh.Boxes.of(df, 4, 4, 2, 20, None, 7)
    keys = boxes.keys(x, False)[:, :, 0]
    for t in range(4):
        assert np.bincount(np.unique(keys[:, t], return_inverse=True)[1]).max() < 20 * 8
    found = lsh.knn_lsh(df, "id", "x", 2, rows_per_block=20)
    assert found.count() == 6000 and found.agg(F.max("distance")).first()[0] <= 2.0


def test_rows_there_twice_take_no_places(spark):
    """Copies of rows, keys included, do not push other neighbours out."""
    x = np.array([[float(i), 0.0] for i in range(40)])
    found = lsh.knn_lsh(frame(spark, x).union(frame(spark, x)), "id", "x", 3, rows_per_block=256)
    assert found.where("id between 3 and 36").agg(F.max("distance")).first()[0] == 2.0


def test_kernel_features_are_spread(spark, monkeypatch):
    monkeypatch.setattr(models, "TASK_BYTES", 4000)
    df = spark.createDataFrame([(float(i % 2), float(i % 2)) for i in range(200)], "x double, label double").coalesce(1)
    spread = []
    plain = models.LinearSVC._fit
    monkeypatch.setattr(models.LinearSVC, "_fit", lambda self, d: (spread.append(d.rdd.getNumPartitions()), plain(self, d))[1])
    out = models.score(models.KernelSVM(["x"], "label", gamma=1.0, width=10).fit(df), df, ["x"])
    assert out.where("x <> prediction").isEmpty() and spread[0] >= 4


def test_starts_are_spread(spark):
    points = frame(spark, np.zeros((9000, 1))).coalesce(1)
    assert starts._spread(points, 9000).rdd.getNumPartitions() == 3


def test_blocks_far_from_the_origin_leave_few_candidates():
    """Lines of points a thousand units apart, millions from the origin: only near pairs are looked at twice."""
    i = np.random.default_rng(3).permutation(np.arange(200_000, 202_000))[:1200]
    x = np.column_stack([np.floor(i / 50) * 1000.0, (i % 50) * (1 + i // 50 % 5) * 0.1])
    a, b = x[:600], x[600:]
    sq = ((a[:, None] - b[None]) ** 2).sum(-1)
    found = V.Near(a, b).candidates(np.full(len(a), 2.25))
    assert set(zip(*np.nonzero(sq <= 2.25))) <= set(zip(*found)) and len(found[0]) < len(a) * 60
    assert V.sq_distances(a, b) == pytest.approx(sq, rel=1e-6)
    near = np.random.default_rng(4).normal(size=(50, 3))
    assert V._near_origin(near, near)[0] is near
