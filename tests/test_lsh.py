import numpy as np
import pytest
from pyspark.sql import functions as F

from calibra.operators import labels as L, lsh, neighbors as N


def frame(spark, points, **more):
    rows = [(i, [float(v) for v in p], *[v[i] for v in more.values()]) for i, p in enumerate(points)]
    schema = "id int, x array<double>" + "".join(f", {c} int" for c in more)
    return spark.createDataFrame(rows, schema)


def clustered(seed, n, dim=6, groups=12):
    rng = np.random.default_rng(seed)
    return rng.normal(0, 10, (groups, dim))[rng.integers(0, groups, n)] + rng.normal(0, 1, (n, dim))


@pytest.mark.parametrize("rows_per_block", [64, 200, 5000])
def test_recall_on_clustered_points(spark, rows_per_block):
    df = frame(spark, clustered(1, 900))
    exact = N.knn(df, "id", "x", 5)
    found = lsh.recall(lsh.knn_lsh(df, "id", "x", 5, rows_per_block=rows_per_block), exact, "id").first()
    assert found["wanted"] == 4500 and found["recall"] >= 0.9


def test_distances_and_order_are_exact(spark):
    points = clustered(2, 300)
    got = lsh.knn_lsh(frame(spark, points), "id", "x", 4, rows_per_block=64).collect()
    by_row = {}
    for r in got:
        assert r["distance"] == pytest.approx(np.linalg.norm(points[r["id"]] - points[r["neighbor"]]), rel=1e-12)
        by_row.setdefault(r["id"], []).append((r["rank"], r["distance"], r["neighbor"]))
    for rows in by_row.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert rows == sorted(rows, key=lambda r: (r[1], r[2])) and len({r[2] for r in rows}) == len(rows)


def test_one_box_is_the_exact_search(spark):
    points = np.vstack([clustered(3, 120), np.repeat(clustered(4, 3), 30, axis=0)])
    df = frame(spark, points, tag=list(range(len(points))))
    for options in ({}, {"include_self": True}, {"payload": ["tag"]}, {"queries": df.where("id % 7 = 0")}):
        exact = sorted(map(tuple, N.knn(df, "id", "x", 4, **options).collect()))
        assert sorted(map(tuple, lsh.knn_lsh(df, "id", "x", 4, width=1e9, tables=1, **options).collect())) == exact


def test_hot_box_of_copies_and_near_copies(spark):
    """A third of the rows are one point and a third lie in one box: blocks of a box meet in many tasks."""
    rng = np.random.default_rng(5)
    points = np.vstack([np.ones((200, 3)), 5 + rng.normal(0, 1e-3, (200, 3)), rng.normal(0, 50, (200, 3))])
    df = frame(spark, points)
    found = lsh.knn_lsh(df, "id", "x", 3, rows_per_block=32).cache()
    exact = N.knn(df, "id", "x", 3)
    near = lsh.recall(found.where("id < 400"), exact.where("id < 400"), "id").first()
    assert near["recall"] >= 0.99
    assert found.where("id < 200 and distance > 0").count() == 0


def test_same_for_any_partitioning(spark):
    df = frame(spark, clustered(6, 200))
    first = sorted(map(tuple, lsh.knn_lsh(df, "id", "x", 3, rows_per_block=50).collect()))
    again = sorted(map(tuple, lsh.knn_lsh(df.repartition(7), "id", "x", 3, rows_per_block=50).collect()))
    assert [r[:3] for r in first] == [r[:3] for r in again]
    assert [r[3] for r in first] == pytest.approx([r[3] for r in again])


def test_votes_by_approximate_neighbours(spark):
    points = clustered(7, 400, groups=4)
    label = [int(np.argmin(np.linalg.norm(p - points[:1], axis=1)) + (p[0] > 0)) for p in points]
    df = frame(spark, points, label=label)
    train, test = df.where("id % 5 > 0"), df.where("id % 5 = 0")
    near = N.knn_classify(train, test, "id", "x", "label", 5, search=lsh.knn_lsh)
    far = N.knn_classify(train, test, "id", "x", "label", 5)
    agree = near.join(far.select("id", F.col("predicted").alias("p")), "id").where("p = predicted").count()
    assert agree >= 0.95 * test.count()
    assert L.relabel(df, "id", "x", "label", 5, search=lsh.knn_lsh).count() == 400


def test_small_and_empty_tables(spark):
    assert lsh.knn_lsh(frame(spark, clustered(8, 3)), "id", "x", 5).count() == 6
    empty = spark.createDataFrame([], "id int, x array<double>")
    assert lsh.knn_lsh(empty, "id", "x", 5).count() == 0
    assert lsh.recall(lsh.knn_lsh(empty, "id", "x", 5), lsh.knn_lsh(empty, "id", "x", 5), "id").first()["recall"] is None
