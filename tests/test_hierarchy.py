"""Spanning tree, hierarchy and outlier scores against plain versions on all pairs."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from calibra.operators import density, hierarchy as H


def sample(seed, copies=12):
    rng = np.random.default_rng(seed)
    lumps = [rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 0.4, 30), ((5, 0), 0.8, 25), ((5.5, 4), 0.2, 20), ((-6, 6), 0.1, 9))]
    x = np.vstack([*lumps, rng.uniform(-10, 10, (12, 2)), np.repeat([[2.0, 2.0]], copies, axis=0), np.repeat([[9.0, 9.0]], 3, axis=0)])
    return x[rng.permutation(len(x))]


def grid(seed):
    """Whole numbers: many distances are equal."""
    return np.random.default_rng(seed).integers(0, 9, (90, 2)).astype(float)


def plain_reach(x, min_samples):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d + np.diag(np.full(len(x), np.inf)), axis=1)[:, min(min_samples, len(x) - 1) - 1]
    return np.maximum(d, np.maximum(core[:, None], core[None, :]))


def distinct(x, min_samples):
    """Distinct points, how often they occur, the row each row is a copy of, and their reach."""
    firsts, seen, of = [], {}, []
    for i, p in enumerate(map(tuple, x)):
        seen.setdefault(p, len(firsts))
        if seen[p] == len(firsts):
            firsts.append(i)
        of.append(seen[p])
    return firsts, np.bincount(of), of, plain_reach(x, min_samples)[np.ix_(firsts, firsts)]


def plain_weights(reach):
    n, inside, best, out = len(reach), [0], reach[0].copy(), []
    while len(inside) < n:
        best[inside] = np.inf
        j = int(best.argmin())
        out.append(best[j])
        inside.append(j)
        best = np.minimum(best, reach[j])
    return sorted(out)


def parts_below(nodes, reach, limit):
    """Components of the nodes linked below the limit."""
    left, out = set(nodes), []
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            a = queue.pop()
            group.add(a)
            near = [b for b in left if reach[a, b] < limit]
            left -= set(near)
            queue += near
        out.append(sorted(group))
    return out


def joining_weight(nodes, reach):
    """Greatest weight of a spanning tree of the nodes."""
    return plain_weights(reach[np.ix_(nodes, nodes)])[-1]


def plain_hierarchy(x, min_samples, least):
    """Cluster (smallest row of it) and score of every row, from the top down."""
    firsts, w, of, reach = distinct(x, min_samples)
    leaves, clusters = {}, []

    def size(nodes):
        return int(sum(w[n] for n in nodes))

    def go(nodes, birth, parent):
        me = len(clusters)
        clusters.append({"nodes": nodes, "parent": parent, "sum": 0.0, "birth": birth, "top": 0.0, "children": []})
        level = birth
        while True:
            if len(nodes) > 1:
                weight = joining_weight(nodes, reach)
                level = 1 / weight
                parts = parts_below(nodes, reach, weight)
            else:
                parts = []
            large = [p for p in parts if size(p) >= least]
            out = nodes if len(large) != 1 else [n for p in parts if size(p) < least for n in p]
            clusters[me]["sum"] += size(out) * level
            clusters[me]["top"] = max(clusters[me]["top"], level)
            inner = {n for p in large for n in p}
            for n in out:
                if n not in inner:
                    leaves[n] = (me, level)
            if len(large) == 1:
                nodes = large[0]
                continue
            for p in large:
                clusters[me]["children"].append(go(p, level, me))
            break
        clusters[me]["top"] = max([clusters[me]["top"]] + [clusters[c]["top"] for c in clusters[me]["children"]])
        return me

    every = list(range(len(firsts)))
    if size(every) < least or len(every) < 2:
        return [(-1, None)] * len(x)
    root = go(every, 0.0, None)
    best, chosen = {}, {}

    def pick(c):
        below = [s for k in clusters[c]["children"] for s in pick(k)]
        own = clusters[c]["sum"] - size(clusters[c]["nodes"]) * clusters[c]["birth"]
        if c != root and own >= sum(best[s] for s in below) - 1e-9:
            best[c] = own
            return [c]
        return below

    for c in pick(root):
        for n in clusters[c]["nodes"]:
            chosen[n] = c
    names = {}
    for row, n in enumerate(of):
        if n in chosen:
            names.setdefault(chosen[n], row)
    return [(names[chosen[n]] if n in chosen else -1, 1 - leaves[n][1] / clusters[leaves[n][0]]["top"]) for n in of]


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "id int, x array<double>")


@pytest.mark.parametrize(("rows_per_block", "task_edges"), [(2048, 10**6), (25, 40)])
@pytest.mark.parametrize("make", [sample, grid])
def test_tree_weights(spark, make, rows_per_block, task_edges):
    x = make(1)
    want = plain_weights(distinct(x, 4)[3])
    tree = H.spanning_tree(frame(spark, x), "id", "x", 4, rows_per_block, task_edges).collect()
    assert sorted(r["weight"] for r in tree) == pytest.approx(want)
    up = {}

    def find(a):
        while a in up:
            a = up[a]
        return a

    for r in tree:
        a, b = find(r["id"]), find(r["other"])
        assert a != b
        up[a] = b


def by_first(rows, n):
    first = {}
    for i in range(n):
        first.setdefault(rows[i][0], i)
    return [(-1 if rows[i][0] == -1 else first[rows[i][0]], rows[i][1]) for i in range(n)]


@pytest.mark.parametrize(("make", "seed"), [(sample, 1), (grid, 3)])
def test_clusters_and_scores(spark, make, seed):
    x, sizes = make(seed), [4, 8, 15]
    rows = H.density_hierarchies(frame(spark, x), "id", "x", 4, sizes).collect()
    for config, least in enumerate(sizes):
        got = {r["id"]: (r["cluster"], r["outlier_score"]) for r in rows if r["config"] == config}
        want = plain_hierarchy(x, 4, least)
        found = by_first(got, len(x))
        assert [f[0] for f in found] == [w[0] for w in want]
        assert [f[1] for f in found] == pytest.approx([w[1] for w in want])
        numbers = [c for c, _ in (got[i] for i in range(len(x))) if c >= 0]
        assert list(dict.fromkeys(numbers)) == sorted(set(numbers))


def test_slabs_give_the_same(spark):
    _, nodes = H._nodes(frame(spark, sample(2)[:60]), "id", "x", 3, 2048)
    tree = H._tree(nodes, 2048, 10**6)
    got = []
    for task_edges in (10**6, 40):
        places, clusters = H.condense(tree, nodes, 5, task_edges)
        rows = {r["cluster"]: r for r in clusters.collect()}
        # Names of clusters differ; their sizes, levels and stabilities do not.
        name = {c: (r["size"], round(r["top"], 9), r["taken"], r["stability"] and round(r["stability"], 6)) for c, r in rows.items()}
        up = sorted((name[c], name.get(r["parent"])) for c, r in rows.items() if r["parent"] is not None)
        left = sorted((r["node"], name[r["cluster"]], round(r["level"], 9)) for r in places.collect())
        got.append((sorted(map(str, name.values())), up, left))
    assert got[0] == got[1] and len(H._slabs(tree, 40)) > 2


def test_too_many_edges_of_one_weight_fail_loudly(spark):
    with pytest.raises(ValueError, match="one weight"):
        H._slabs(spark.createDataFrame([(i, i + 1, 1.0) for i in range(30)], "u bigint, v bigint, weight double"), 10)


def test_sweep_of_least_sizes(spark):
    scores = H.hierarchy_sweep(frame(spark, sample(1)), "id", "x", 4, [4, 8, 400]).collect()
    assert sum(r["chosen"] for r in scores) == 1 and {r["min_cluster_size"] for r in scores} == {4, 8, 400}
    assert next(r for r in scores if r["min_cluster_size"] == 400)["clusters"] == 0


def test_few_points(spark):
    one = frame(spark, [[1.0, 2.0]])
    assert [tuple(r) for r in H.density_hierarchy(one, "id", "x", 3, 5).collect()] == [(0, -1, None)]
    assert H.spanning_tree(one, "id", "x", 3).count() == 0
    assert H.density_hierarchy(frame(spark, []), "id", "x", 3, 5).count() == 0
    same = frame(spark, [[1.0, 2.0]] * 9)
    assert {r["cluster"] for r in H.density_hierarchy(same, "id", "x", 3, 5).collect()} == {-1}


def digits(df, capsys):
    """Digits of the greatest size that Spark estimates in the plan."""
    capsys.readouterr()
    df.explain("cost")
    return max((int(d) for d in re.findall(r"sizeInBytes=[\d.]+E\+(\d+) B", capsys.readouterr().out)), default=0)


def test_estimated_sizes_stay_small_in_loops(spark, capsys):
    """Joins of a loop's result with itself must not multiply its estimate round by round; that fills the driver."""
    number = F.col("id")
    line = spark.range(40).select(number.alias("cluster"), F.when(number > 0, number - 1).alias("parent"), (number % 7 == 3).alias("taken"))
    highest = H._highest_taken(line)
    # The highest taken one is 3, for all below it.
    assert {r["cluster"]: r["chosen"] for r in highest.collect()} == {i: 3 if i >= 3 else None for i in range(40)}
    assert digits(highest, capsys) < 30
    groups = density.components(spark.range(40).select(F.lit(0).alias("config"), number.alias("u"), (number + 1).alias("v")))
    assert {r["component"] for r in groups.collect()} == {0} and digits(groups, capsys) < 60
    edges = spark.range(60).select(number.alias("u"), (number + 1).alias("v"), (number % 7).cast("double").alias("weight"))
    tree = H.lightest_tree(edges, 10)
    assert tree.count() == 60 and digits(tree, capsys) < 60
