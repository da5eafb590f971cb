"""Neighbour, density and silhouette operators against brute force, with copies and many blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from calibra.operators import clusters, density, labels, neighbors

ROWS = 30


def make_points(copies=60, seed=5):
    """Three lumps in four dimensions plus a large group of copies of one point."""
    rng = np.random.default_rng(seed)
    lumps = [rng.normal(c, 0.4, size=(50, 4)) for c in (0.0, 3.0, 6.0)]
    noise = rng.uniform(-4, 10, size=(20, 4))
    same = np.repeat([[3.0, 3.0, 3.0, 3.0]], copies, axis=0)
    x = np.vstack([*lumps, noise, same])
    return x[rng.permutation(len(x))]


@pytest.fixture(scope="module")
def x():
    return make_points()


@pytest.fixture(scope="module")
def points(spark, x):
    data = [(i, [float(v) for v in r], int(i % 3)) for i, r in enumerate(x)]
    return spark.createDataFrame(data, "id bigint, v array<double>, label int").repartition(3)


@pytest.fixture(scope="module")
def dist(x):
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))


def brute_knn(dist, k, include_self=False):
    out = {}
    for i, row in enumerate(dist):
        order = sorted((j for j in range(len(row)) if j != i), key=lambda j: (row[j], j))
        out[i] = ([i] + order)[:k] if include_self else order[:k]
    return out


@pytest.mark.parametrize("rows_per_block", [ROWS, 2048])
@pytest.mark.parametrize("include_self", [False, True])
def test_knn(points, dist, rows_per_block, include_self):
    got = neighbors.knn(points, "id", "v", 6, include_self=include_self, rows_per_block=rows_per_block).collect()
    expected = brute_knn(dist, 6, include_self)
    found = {}
    for r in sorted(got, key=lambda r: (r["id"], r["rank"])):
        found.setdefault(r["id"], []).append(r["neighbor"])
        assert r["distance"] == pytest.approx(dist[r["id"], r["neighbor"]], abs=1e-12)
    assert found == expected


def test_knn_of_other_points(spark, points, x, dist):
    asked = points.where("id % 4 = 0")
    base = points.where("id % 4 <> 0")
    got = neighbors.knn(base, "id", "v", 5, queries=asked, payload=["label"], rows_per_block=ROWS).collect()
    for i in range(0, len(x), 4):
        order = sorted((j for j in range(len(x)) if j % 4), key=lambda j: (dist[i, j], j))[:5]
        mine = sorted((r for r in got if r["id"] == i), key=lambda r: r["rank"])
        assert [r["neighbor"] for r in mine] == order
        assert [r["label"] for r in mine] == [j % 3 for j in order]


def brute_dbscan(dist, eps, min_samples):
    n = len(dist)
    near = dist <= eps
    core = near.sum(1) >= min_samples
    comp = np.full(n, -1)
    number = 0
    for i in range(n):
        if core[i] and comp[i] < 0:
            stack, comp[i] = [i], number
            while stack:
                j = stack.pop()
                for k in np.nonzero(near[j] & core & (comp < 0))[0]:
                    comp[k] = number
                    stack.append(k)
            number += 1
    out = comp.copy()
    for i in range(n):
        if not core[i]:
            reach = comp[near[i] & core]
            out[i] = reach.min() if len(reach) else -1
    return out


@pytest.mark.parametrize("rows_per_block", [ROWS, 2048])
def test_dbscan(points, dist, rows_per_block):
    for eps, m in [(0.7, 4), (1.5, 3)] if rows_per_block == ROWS else [(0.7, 4)]:
        got = density.dbscan(points, "id", "v", eps, m, rows_per_block=rows_per_block).collect()
        expected = brute_dbscan(dist, eps, m)
        assert {r["id"]: r["cluster"] for r in got} == dict(enumerate(expected.tolist()))


def test_dbscan_without_core_points(points):
    got = density.dbscan(points, "id", "v", 1e-9, 1000, rows_per_block=ROWS)
    assert {r["cluster"] for r in got.select("cluster").distinct().collect()} == {-1}


def test_dbscan_sweep_marks_the_best(points, dist):
    table = density.dbscan_sweep(points, "id", "v", [0.5, 1.0], [3, 8], rows_per_block=ROWS).collect()
    assert len(table) == 4 and sum(r["chosen"] for r in table) == 1
    best = next(r for r in table if r["chosen"])
    valid = [r for r in table if r["clusters"] >= 2 and r["clustered_share"] >= 0.5]
    assert best["silhouette"] == max(r["silhouette"] for r in valid)
    for r in table:
        assert r["noise"] == (brute_dbscan(dist, r["eps"], r["min_samples"]) == -1).sum()


def brute_silhouette(dist, label):
    keep = label != -1
    d, lab = dist[np.ix_(keep, keep)], label[keep]
    out = []
    for i in range(len(lab)):
        own = lab == lab[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab.tolist()) - {lab[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("rows_per_block", [ROWS, 2048])
def test_silhouettes(points, dist, rows_per_block):
    df = points.withColumn("noisy", F.when(F.col("id") % 7 == 0, -1).when(F.col("id") == 1, 9).otherwise(F.col("label")))
    got = {r["labeling"]: r for r in neighbors.silhouettes(df, "id", "v", ["label", "noisy"], rows_per_block).collect()}
    ids = np.arange(len(dist))
    noisy = np.where(ids % 7 == 0, -1, np.where(ids == 1, 9, ids % 3))
    assert got["label"]["silhouette"] == pytest.approx(brute_silhouette(dist, ids % 3), abs=1e-9)
    assert got["noisy"]["silhouette"] == pytest.approx(brute_silhouette(dist, noisy), abs=1e-9)
    assert got["noisy"]["points"] == (noisy != -1).sum()


def test_components(spark):
    edges = [(0, i, i + 1) for i in range(12)] + [(0, 100, 101), (1, 5, 4), (1, 9, 9)]
    got = density.components(spark.createDataFrame(edges, "config int, u int, v int")).collect()
    place = {(r["config"], r["node"]): r["component"] for r in got}
    assert all(place[0, i] == 0 for i in range(13))
    assert place[0, 101] == 100 and place[1, 5] == 4 and place[1, 9] == 9


def test_density_levels_and_fallback(points):
    marks, scores = density.density_levels(points, "id", "v", 4, 10, levels=3, neighbors=6, rows_per_block=ROWS)
    assert scores.count() == 3
    per = marks.groupBy("config", "cluster").count().where("cluster <> -1").collect()
    assert all(r["count"] >= 10 for r in per)
    none = density.density_clusters(points, "id", "v", 4, 10_000, seed=1, levels=2, neighbors=5, rows_per_block=ROWS)
    assert none.select("cluster").distinct().count() == 2


def test_density_outlier_scores(points):
    lab = density.dbscan(points, "id", "v", 1.0, 4, rows_per_block=ROWS)
    core = density.core_distance(points, "id", "v", 4, rows_per_block=ROWS)
    scores = density.density_outlier(lab, core, "id")
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    assert low >= 0 and high <= 1
    assert scores.where("cluster >= 0").groupBy("cluster").agg(F.min("score").alias("m")).where("m > 1e-12").count() == 0


def test_relabel_with_and_without_self(spark, dist):
    x = make_points(copies=1, seed=8)
    df = spark.createDataFrame([(i, [float(v) for v in r], int(r[0] > 1.5) + int(r[0] > 4.5)) for i, r in enumerate(x)], "id int, v array<double>, y int")
    wrong = df.withColumn("y", F.when(F.col("id") % 10 == 0, (F.col("y") + 1) % 3).otherwise(F.col("y")))
    out = labels.relabel(wrong, "id", "v", "y", k=11, rows_per_block=ROWS)
    summary = labels.relabel_summary(out, "y").first()
    assert 0 < summary["relabeled"] <= summary["max_relabel"]
    assert out.join(df.withColumnRenamed("y", "truth"), "id").where("relabeled and clean = truth").count() > 0.5 * summary["relabeled"]
    capped = labels.relabel(wrong, "id", "v", "y", k=11, cap=0.02, rows_per_block=ROWS)
    assert capped.where("relabeled").count() == int(len(x) * 0.02)
    same = labels.relabel(wrong, "id", "v", "y", k=11, include_self=True, rows_per_block=ROWS)
    assert labels.relabel_summary(same, "y").first()["disagree"] == 0


def test_subtractive_against_brute_force(points, x, dist):
    ra, rb = 1.5, 2.25
    p = np.exp(-(dist**2) / (ra / 2) ** 2).sum(1)
    base = clusters.potentials(points, "id", "v", ra, rows_per_block=ROWS).collect()
    for r in base:
        assert r["potential"] == pytest.approx(p[r["id"]], rel=1e-9)
    centers, first = [], p.max()
    while len(centers) < 26:
        i = int(np.argmax(np.round(p, 9)))
        if p[i] < 0.15 * first or (centers and p[i] < 0.5 * first):
            break
        centers.append(x[i])
        p = p - p[i] * np.exp(-((x - x[i]) ** 2).sum(1) / (rb / 2) ** 2)
    assigned, got = clusters.subtractive(points, "id", "v", ra, rows_per_block=ROWS)
    assert np.allclose(got, centers)
    expected = ((x[:, None] - np.array(centers)[None]) ** 2).sum(-1).argmin(1)
    assert {r["id"]: r["cluster"] for r in assigned.collect()} == dict(enumerate(expected.tolist()))


def test_fuzzy_memberships(points):
    assigned, centers = clusters.fuzzy_cmeans(points, "id", "v", 3, seed=1)
    rows = assigned.collect()
    assert len(centers) == 3
    for r in rows:
        assert sum(r["u"]) == pytest.approx(1.0)
        assert r["cluster"] == int(np.argmax(r["u"]))


def brute_merge(dist, x, linkage):
    groups = {i: [i] for i in range(len(x))}
    heights = []
    while len(groups) > 1:
        best = None
        keys = sorted(groups)
        for n, a in enumerate(keys):
            for b in keys[n + 1 :]:
                one, two = groups[a], groups[b]
                block = dist[np.ix_(one, two)]
                if linkage == "ward":
                    gap = x[one].mean(0) - x[two].mean(0)
                    h = np.sqrt(2 * len(one) * len(two) / (len(one) + len(two)) * (gap**2).sum())
                else:
                    h = block.mean() if linkage == "average" else block.max()
                if best is None or h < best[0]:
                    best = (h, a, b)
        h, a, b = best
        heights.append(h)
        groups[a] = groups[a] + groups.pop(b)
    return heights


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_merge_is_exact_when_every_row_is_its_own_group(spark, linkage):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(25, 3))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    micro = spark.createDataFrame([(i, [float(v) for v in r], i) for i, r in enumerate(x)], "id int, x array<double>, micro int")
    table = clusters.merge_table(micro, "id", linkage, rows_per_block=10).orderBy("step").collect()
    assert [r["distance"] for r in table] == pytest.approx(brute_merge(dist, x, linkage))
    assert table[-1]["size"] == 25


def test_micro_agglomerative(points):
    for linkage in ("ward", "average", "complete"):
        scores, assigned = clusters.micro_agglomerative(points, "id", "v", linkage, [2, 3, 4], 24, 7, rows_per_block=ROWS)
        best = scores.orderBy(F.desc("silhouette")).first()["k"]
        assert assigned.select("cluster").distinct().count() == best


def test_best_linkage_is_the_best_of_each(points):
    scores, assigned = clusters.best_linkage(points, "id", "v", ["ward", "average", "complete"], [2, 3, 4], 24, 7, rows_per_block=ROWS)
    rows = scores.collect()
    assert len(rows) == 9 and [r["silhouette"] for r in rows if r["chosen"]] == [max(r["silhouette"] for r in rows)]
    assert assigned.select("cluster").distinct().count() == next(r["k"] for r in rows if r["chosen"])
    one, _ = clusters.micro_agglomerative(points, "id", "v", "average", [2, 3, 4], 24, 7, rows_per_block=ROWS)
    alone = {r["k"]: r["silhouette"] for r in one.collect()}
    assert {r["k"]: r["silhouette"] for r in rows if r["linkage"] == "average"} == pytest.approx(alone)


def plain_cuts(x, w, linkage, ks):
    """Labelings after the merges of all points, two nearest at a time."""
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    if linkage == "ward":
        dist = np.sqrt(2 * np.outer(w, w) / (w[:, None] + w[None])) * dist
    steps = clusters._merge(w, dist, linkage)
    return [clusters._cut(len(x), steps, k) for k in ks]


def grouping(labels):
    return sorted(sorted(i for i, c in enumerate(labels) if c == v) for v in set(labels))


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_all_rows_are_merged(spark, linkage):
    """Rounds of merges by parts, with copies, lone points far away and clusters larger than a block and than a lot."""
    rng = np.random.default_rng(11)
    x = np.vstack([rng.normal(0, 1, (60, 3)), rng.normal(9, 1, (30, 3)), [[40.0, 0, 0], [41, 0, 0.5], [0, 80, 0]]])
    w = np.where(np.arange(len(x)) % 7 == 0, 2, 1)
    rows = np.repeat(x, w, axis=0)
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(rows)], "id int, x array<double>")
    first = np.cumsum(w) - w
    _, assigned = clusters.best_linkage(df, "id", "x", [linkage], [4], None, 0, rows_per_block=8, last=50)
    found = {r["id"]: r["cluster"] for r in assigned.collect()}
    assert len(found) == len(rows) and all(found[i] == found[i + 1] for i in first[w == 2])
    assert grouping([found[i] for i in first]) == grouping(plain_cuts(x, w.astype(float), linkage, [4])[0])


def test_too_many_micro_clusters_fail_loudly(points):
    with pytest.raises(ValueError, match="micro-clusters"):
        clusters.merge_table(points.withColumn("micro", F.col("id").cast("int")).withColumnRenamed("v", "x"), "id", max_micro=50)


@pytest.mark.parametrize("linkage", ["ward", "average", "complete"])
def test_merges_with_equal_distances(linkage):
    """Whole numbers: always the first of the nearest pairs, as a plain search over all pairs finds it."""
    rng = np.random.default_rng(6)
    for _ in range(20):
        x, n = rng.integers(0, 6, (15, 2)).astype(float), np.ones(15)
        dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        heights = [s[2] for s in clusters._merge(n, dist, linkage)]
        assert heights == pytest.approx(sorted(heights)) and len(heights) == 14
        if linkage == "ward":
            assert sum(h * h for h in heights) / 2 == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())


def test_elbow_inertia_falls(points):
    table = clusters.elbow(points, "id", "v", [1, 2, 3, 4], [1, 2, 3], rows_per_block=ROWS).orderBy("k").collect()
    costs = [r["inertia"] for r in table]
    assert costs == sorted(costs, reverse=True)
    assert table[0]["silhouette"] is None and sum(r["best"] for r in table) == 1


def test_stability_of_clear_lumps(points):
    def fit(sample, seed):
        return clusters.kmeans(sample, "id", "v", 3, [1, 2, 3])[0]

    summary, rounds = labels.stability(points.select("id", "v"), "id", fit(points, 1), fit, rounds=2, seed=3)
    assert rounds.count() == 2 and summary.first()["mean"] > 0.5
