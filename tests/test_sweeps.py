"""Sweeps over pairs of points: each distance once, in single precision where that decides; results as from plain distances."""

import numpy as np
import pandas as pd
import pytest

from calibra.functions import blocks as B, vectors as V
from calibra.operators import density, hierarchy, neighbors


def plain(a, b):
    return ((a[:, None] - b[None]) ** 2).sum(-1)


@pytest.mark.parametrize("scale", [1.0, 1e-30, 1e25, 1e-3])
def test_pairs_within_are_exact(scale):
    rng = np.random.default_rng(1)
    a, b = (np.round(rng.normal(size=(n, 5)), 1) * scale for n in (300, 290))
    b[:40] = a[:40]
    sq = plain(a, b)
    limits = [0.0, 1.0 * scale * scale, float(sq[7, 9]), 1e300]
    near = V.Near(a, b)
    for mask, limit in zip(near.masks(limits), limits):
        assert (mask == (sq <= limit)).all()
    own = np.quantile(sq, 0.02, axis=1)
    i, j = near.candidates(own)
    found = np.zeros(sq.shape, dtype=bool)
    found[i, j] = True
    assert found[sq <= own[:, None]].all()


def test_pairs_far_from_the_origin_are_exact():
    rng = np.random.default_rng(2)
    a, b = (1e4 + rng.normal(size=(n, 3)) for n in (400, 300))
    limit = float(np.quantile(plain(a, b), 0.1))
    assert (V.Near(a, b).masks([limit])[0] == (plain(a, b) <= limit)).all()
    assert V.sq_distances(a, b) == pytest.approx(plain(a, b), rel=1e-6) and (np.diag(V.sq_distances(a, a)) == 0).all()


def pieces(x, rows):
    frame = pd.DataFrame({"id": np.arange(len(x)), "x": list(x), "members": [[{"key": i}] for i in range(len(x))]})
    return [frame.iloc[s : s + rows] for s in range(0, len(x), rows)]


def test_neighbours_measure_few_pairs(monkeypatch):
    """After the first block a point measures only what may be nearer than what it has."""
    x = np.random.default_rng(3).normal(size=(1200, 8))
    x[500:520] = x[100:120]
    whole, measured = [], []
    square, pair = neighbors.sq_distances, neighbors.pair_squares
    monkeypatch.setattr(neighbors, "sq_distances", lambda a, b: (whole.append(len(a) * len(b)), square(a, b))[1])
    monkeypatch.setattr(neighbors, "pair_squares", lambda a, i, b, j: (measured.append(len(i)), pair(a, i, b, j))[1])
    blocks = pieces(x, 100)
    B.forget()
    found = neighbors._nearest_sweep(4, [])(blocks, blocks, [list(range(12))] * 12)
    assert sum(whole) == 12 * 100 * 100 and sum(measured) < 1200 * 40
    for i, part in found.groupby("id"):
        dist = np.sqrt(plain(x[[i]], x)[0])
        want = np.lexsort((np.arange(len(x)), dist))[:4]
        assert part["neighbor"].tolist() == want.tolist() and part["distance"].tolist() == pytest.approx(dist[want].tolist())


def test_sums_need_a_distance_once(monkeypatch):
    x, label = np.random.default_rng(4).normal(size=(90, 3)), np.arange(90) % 4 - 1
    frame = pd.DataFrame({"id": np.arange(90), "x": list(x), "w": 2, "ls": [np.array([v, v]) for v in label]})
    blocks, seen = [frame.iloc[s : s + 30] for s in (0, 30, 60)], []
    square = neighbors.sq_distances
    monkeypatch.setattr(neighbors, "sq_distances", lambda a, b: (seen.append(1), square(a, b))[1])
    B.forget()
    got = neighbors._cluster_sums([0, 1], True)(blocks, blocks, [[0, 1, 2], [1, 2], [2]])
    assert len(seen) == 6 and len(got) == 2 * 3 * (label != -1).sum()
    dist = np.sqrt(plain(x, x))
    for r in got.itertuples():
        assert r.s == pytest.approx(2 * dist[r.id, label == r.cluster].sum(), abs=1e-9)


def test_weights_of_a_mask():
    rng = np.random.default_rng(5)
    left, right = rng.integers(1, 9, 50), rng.integers(1, 9, 40)
    for share in (0.0, 0.05, 0.6):
        mask = rng.random((50, 40)) < share
        one, two = density._weights(mask, left, right)
        assert (one == mask.astype(int) @ right).all() and (two == left @ mask.astype(int)).all()


def test_tree_of_a_pair_of_blocks():
    rng = np.random.default_rng(6)
    x, core = rng.normal(size=(40, 2)), rng.random(40) * 0.2
    frame = pd.DataFrame({"node": np.arange(40), "x": list(x), "core": core})
    B.forget()
    one, two = frame.iloc[:25], frame.iloc[25:]
    edges = pd.concat([hierarchy._forest(one, one), hierarchy._forest(one, two), hierarchy._forest(two, two)])
    reach = np.maximum(np.sqrt(plain(x, x)), np.maximum(core[:, None], core[None]))
    every = pd.DataFrame([(i, j, reach[i, j]) for i in range(40) for j in range(i + 1, 40)], columns=["u", "v", "weight"])
    assert hierarchy._kruskal(edges)["weight"].sum() == pytest.approx(hierarchy._kruskal(every)["weight"].sum())
