"""The grid form of the density clustering against the form on blocks and against all pairs."""

import numpy as np
import pytest
from test_hierarchy import frame, parts_below, sample

from calibra.operators import density, density_grid as G


def plain(x, eps, least):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    near = d <= eps * (1 + 1e-12)
    core = near.sum(axis=1) >= least
    groups = parts_below(np.flatnonzero(core).tolist(), np.where(near, 0.0, 1.0), 0.5)
    number = {n: c for c, group in enumerate(sorted(groups, key=min)) for n in group}
    return [number[i] if core[i] else min((number[j] for j in np.flatnonzero(near[i] & core)), default=-1) for i in range(len(x))]


def lines(dims):
    """Long dense stripes, one of them cut in two by a gap in reach and one by a gap out of reach."""
    rng = np.random.default_rng(4)
    a = np.zeros((500, dims))
    a[:, 0] = np.concatenate([np.linspace(0, 3, 250), np.linspace(3.49, 6, 250)])
    b = a + 5.0
    b[250:, 0] += 0.2
    return np.vstack([a, b, rng.uniform(-1, 9, (60, dims))])


@pytest.mark.parametrize(("make", "eps", "least", "rows_per_block"), [
    (lambda: sample(1), 0.7, 5, 2048), (lambda: sample(2), 0.7, 1, 20), (lambda: lines(2), 0.5, 6, 40), (lambda: lines(3), 0.5, 6, 2048),
    (lambda: sample(3)[:, :1], 0.2, 4, 2048), (lambda: np.random.default_rng(1).integers(0, 30, (300, 2)).astype(float), 1.0, 4, 64),
])
def test_same_as_all_pairs(spark, make, eps, least, rows_per_block):
    x = make()
    got = {r["id"]: r["cluster"] for r in G.dbscan_grid(frame(spark, x), "id", "x", eps, least, rows_per_block=rows_per_block).collect()}
    assert [got[i] for i in range(len(x))] == plain(x, eps, least)


def test_same_as_blocks_on_orders(spark, tables):
    from pyspark.sql import functions as F

    orders = tables("orders").select("o_orderkey", F.array(F.col("o_totalprice") / 1000, F.dayofyear("o_orderdate").cast("double")).alias("x"))
    one = G.dbscan_grid(orders, "o_orderkey", "x", 6.0, 5)
    two = density.dbscan(orders, "o_orderkey", "x", 6.0, 5)
    both = one.join(two.withColumnRenamed("cluster", "other"), "o_orderkey")
    assert both.count() == orders.count() and both.where("cluster <> other").isEmpty()
    assert one.select("cluster").distinct().count() > 3


def test_offsets():
    assert len(G.offsets(1)) == 5 and len(G.offsets(2)) == 25 and (3, 0, 0, 0) in G.offsets(4)


def test_limits(spark):
    assert G.dbscan_grid(frame(spark, []), "id", "x", 1.0, 3).count() == 0
    with pytest.raises(ValueError):
        G.dbscan_grid(frame(spark, np.zeros((3, 5))), "id", "x", 1.0, 3)
    hot = G.dbscan_grid(frame(spark, np.vstack([np.ones((50, 2)), np.ones((1, 2)) * 9])), "id", "x", 1.0, 5)
    assert sorted(r["cluster"] for r in hot.collect()) == [-1] + [0] * 50
