"""Density clustering: connected components, DBSCAN and its sweep, density levels, outlier scores."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.blocks import ROWS_PER_BLOCK, Blocks, as_points, collapse, coordinates, made, spread
from ..functions.ordering import with_position
from ..functions.quantiles import quantiles
from ..functions.sizing import TASK_ROWS, cut_lineage, cut_sizes
from ..functions.vectors import Near
from .neighbors import _type, knn, mutual_distance, silhouettes

NOISE = -1
_EDGE = 1e-12


def components(edges: DataFrame, by: str = "config") -> DataFrame:
    """``(by, node, component)`` for undirected ``(by, u, v)``; the component is its smallest node.

    Every round each node hooks onto its smallest neighbour, follows the hooks one step further,
    and the edges are contracted, so even a chain halves.  Hooks and edges are written each round,
    which keeps the plans short.
    """
    both = edges.select(by, "u", "v").unionByName(edges.select(by, F.col("v").alias("u"), F.col("u").alias("v")))
    edges = cut_sizes(both.distinct())
    place = None
    while True:
        hooks = edges.groupBy(by, F.col("u").alias("node")).agg(F.least(F.first("u"), F.min("v")).alias("component"))
        hooks = cut_lineage(hooks)
        hooks = cut_sizes(_followed(hooks, hooks, by))
        place = hooks if place is None else _followed(place, hooks, by)
        a = hooks.select(by, F.col("node").alias("u"), F.col("component").alias("hu"))
        b = hooks.select(by, F.col("node").alias("v"), F.col("component").alias("hv"))
        shrunk = edges.join(a, [by, "u"]).join(b, [by, "v"]).select(by, F.col("hu").alias("u"), F.col("hv").alias("v"))
        edges = cut_sizes(shrunk.where("u <> v").distinct())
        if edges.isEmpty():
            return place


def _followed(place: DataFrame, hooks: DataFrame, by: str) -> DataFrame:
    """Replace each component by the component it is hooked onto, if any."""
    step = hooks.select(by, F.col("node").alias("component"), F.col("component").alias("__to"))
    moved = place.join(step, [by, "component"], "left")
    return moved.select(by, "node", F.coalesce("__to", "component").alias("component"))


def _numbered(labels: DataFrame, by: str, task_rows: int) -> DataFrame:
    """Replace component names by numbers from 0 in the order of their smallest node."""
    names = labels.select(by, "component").distinct()
    numbers = with_position(names, ["component"], [by], "cluster", task_rows)
    return labels.join(numbers, [by, "component"]).select(by, "id", F.col("cluster").cast("int").alias("cluster"))


def _weights(mask: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the other side's weights over the pairs of a mask, for the rows and for the columns."""
    if np.count_nonzero(mask) * 8 < mask.size:
        i, j = np.divmod(np.flatnonzero(mask), mask.shape[1])
        sums = np.bincount(i, right[j], len(left)), np.bincount(j, left[i], len(right))
    else:
        held = mask.astype(np.float64)
        sums = held @ right.astype(np.float64), left.astype(np.float64) @ held
    # Whole numbers below 2^53.
    return tuple(s.astype(np.int64) for s in sums)


def _groups(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Connected groups of a two-sided graph given as a boolean matrix; -1 for lone nodes."""
    rows, cols = mask.shape
    if np.count_nonzero(mask) * 8 < mask.size:
        return _sparse_groups(mask)
    left = np.where(mask.any(axis=1), np.arange(rows), rows)
    while True:
        right = np.where(mask, left[:, None], rows).min(axis=0, initial=rows)
        new = np.minimum(left, np.where(mask, right[None, :], rows).min(axis=1, initial=rows))
        if (new == left).all():
            return np.where(left == rows, -1, left), np.where(right == rows, -1, right)
        left = new


def _sparse_groups(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from the list of edges, where they are few."""
    i, j = np.divmod(np.flatnonzero(mask), max(mask.shape[1], 1))
    left, right = np.full(mask.shape[0], -1), np.full(mask.shape[1], -1)
    if not len(i):
        return left, right
    order = np.argsort(j, kind="stable")
    mine, a = np.unique(i, return_index=True)
    theirs, b = np.unique(j[order], return_index=True)
    left[mine] = mine
    while True:
        right[theirs] = np.minimum.reduceat(left[i[order]], b)
        new = np.minimum(left[mine], np.minimum.reduceat(right[j], a))
        if (new == left[mine]).all():
            return left, right
        left[mine] = new


def _stars(edges: pd.DataFrame) -> pd.DataFrame:
    """A star for each connected group of the edges of a task: its first node with every node, itself included."""
    out = []
    for config, part in edges.groupby("config", sort=True):
        nodes, ends = np.unique(np.concatenate([part["u"].to_numpy(), part["v"].to_numpy()]), return_inverse=True)
        u, v = ends[: len(part)], ends[len(part) :]
        up = np.arange(len(nodes))
        while True:
            low = np.minimum(up[u], up[v])
            new = up.copy()
            for end in (u, v):
                np.minimum.at(new, up[end], low)
                np.minimum.at(new, end, low)
            new = new[new]
            if (new == up).all():
                break
            up = new
        out.append(pd.DataFrame({"config": config, "u": nodes[up], "v": nodes}))
    return pd.concat(out, ignore_index=True) if out else edges


def dbscan_sweep_labels(
    df: DataFrame,
    key: str,
    features: str,
    configs: list[tuple[float, int]],
    rows_per_block: int = ROWS_PER_BLOCK,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``(config, key, cluster)`` for several ``(eps, min_samples)`` from shared distance work.

    A core point has at least ``min_samples`` points (itself included) within the closed radius
    ``eps``; a border point joins the lowest-numbered cluster with a core point in reach; the
    rest is noise, -1.  Clusters are numbered by their smallest core key.

    Tasks never emit neighbour pairs: first one count per point, then a spanning forest of each
    pair of blocks, then one label per border point.
    """
    points = as_points(df, key, features)
    distinct = collapse(points, key)
    blocks = Blocks.build(distinct, rows_per_block)
    radii = sorted({e for e, _ in configs})
    limits = [e * e * (1 + _EDGE) for e in radii]
    at = [radii.index(e) for e, _ in configs]
    needed = [m for _, m in configs]
    near = blocks.within(blocks, radii[-1])
    id_type = _type(points, key)

    def count(mine: list[pd.DataFrame], theirs: list[pd.DataFrame], met: list[list[int]]) -> pd.DataFrame:
        # A pair of blocks meets once and serves both; a block meets itself as one object.
        sums = {id(f): np.zeros((len(f), len(limits)), dtype=np.int64) for f in [*mine, *theirs]}
        for left, others in zip(mine, met):
            for right in (theirs[j] for j in others):
                for c, held in enumerate(Near(coordinates(left), coordinates(right)).masks(limits)):
                    one, two = _weights(held, left["w"].to_numpy(), right["w"].to_numpy())
                    sums[id(left)][:, c] += one
                    if left is not right:
                        sums[id(right)][:, c] += two
        out = [pd.DataFrame({"id": [], **{f"c{i}": [] for i in range(len(limits))}})]
        for frame in mine if mine is theirs else [*mine, *theirs]:
            out.append(pd.DataFrame({"id": frame["id"].to_numpy(), **{f"c{i}": sums[id(frame)][:, i] for i in range(len(limits))}}))
        return pd.concat([o for o in out if len(o)] or out, ignore_index=True)

    schema = f"id {id_type}, " + ", ".join(f"c{i} bigint" for i in range(len(limits)))
    slim = blocks.points.select("id", "x", "w", "cell", "lot")
    counts = blocks.meet(blocks, near, count, schema, left=slim, right=slim, half=True, sweep=True)
    counts = counts.groupBy("id").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(limits))])
    core = F.array(*[F.col(f"c{a}") >= m for a, m in zip(at, needed)])
    flagged = cut_lineage(slim.drop("w").join(counts, "id").select("id", "x", "cell", "lot", core.alias("core")))

    def forest(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            masks = Near(coordinates(left), coordinates(right)).masks(limits)
            a, b = (made(f, "core", lambda f: np.stack(f["core"].to_numpy())) for f in (left, right))
            ids, others = left["id"].to_numpy(), right["id"].to_numpy()
            for c, i in enumerate(at):
                mine, theirs = np.nonzero(a[:, c])[0], np.nonzero(b[:, c])[0]
                if len(mine) and len(theirs):
                    every = len(mine) == len(a) and len(theirs) == len(b)
                    one, two = _groups(masks[i] if every else masks[i][np.ix_(mine, theirs)])
                    for group, names in ((one, ids[mine]), (two, others[theirs])):
                        held = group >= 0
                        out.append(pd.DataFrame({"config": c, "u": ids[mine][group[held]], "v": names[held]}))
        return pd.concat(out) if out else pd.DataFrame({"config": [], "u": [], "v": []})

    joined = flagged.where(F.exists("core", lambda f: f))
    edges = blocks.meet(blocks, near, forest, f"config int, u {id_type}, v {id_type}", left=joined, right=joined, half=True, merge=_stars, across=True)
    groups = components(edges).withColumnRenamed("node", "id")

    # Component of each point per configuration; only read where the point is a core point.
    per_point = groups.groupBy("id").agg(
        F.array(
            *[F.coalesce(F.max(F.when(F.col("config") == c, F.col("component"))), F.col("id")) for c in range(len(configs))]
        ).alias("comp")
    )
    cores = flagged.join(per_point, "id").drop("id")
    borders = flagged.where(F.exists("core", lambda f: ~f))

    def attach(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            masks = Near(coordinates(left), coordinates(right)).masks(limits)
            a, b = (made(f, "core", lambda f: np.stack(f["core"].to_numpy())) for f in (left, right))
            ids, comp = left["id"].to_numpy(), made(right, "comp", lambda f: np.stack(f["comp"].to_numpy()))
            for c, i in enumerate(at):
                names, have = comp[:, c], b[:, c]
                rows = np.nonzero(~a[:, c])[0]
                if not have.any() or not len(rows):
                    continue
                order, rank = np.unique(names[have], return_inverse=True)
                held = masks[i][np.ix_(rows, np.nonzero(have)[0])]
                best = np.full(len(rows), len(order))
                u, v = np.divmod(np.flatnonzero(held), held.shape[1])
                np.minimum.at(best, u, rank[v])
                hit = best < len(order)
                out.append(pd.DataFrame({"config": c, "id": ids[rows[hit]], "component": order[best[hit]]}))
        return pd.concat(out) if out else pd.DataFrame({"config": [], "id": [], "component": []})

    touched = blocks.meet(
        blocks, near, attach, f"config int, id {id_type}, component {id_type}", left=borders, right=cores,
        merge=lambda f: f.groupby(["config", "id"], as_index=False, sort=False).min(),
    )
    border = touched.groupBy("config", "id").agg(F.min("component").alias("component"))
    clustered = _numbered(groups.select("config", "id", "component").unionByName(border), "config", task_rows)
    wide = clustered.groupBy("id").agg(
        F.array(*[F.max(F.when(F.col("config") == c, F.col("cluster"))) for c in range(len(configs))]).alias("clusters")
    )
    own = blocks.points.select("id", "x").join(wide, "id", "left")
    none = F.array_repeat(F.lit(None).cast("int"), len(configs))
    listed = spread(points, key, own, ["clusters"]).select(
        key, F.posexplode(F.coalesce("clusters", none)).alias("config", "cluster")
    )
    return listed.select("config", key, F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))


def dbscan(
    df: DataFrame, key: str, features: str, eps: float, min_samples: int,
    rows_per_block: int = ROWS_PER_BLOCK, task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``(key, cluster)`` of one density clustering."""
    return dbscan_sweep_labels(df, key, features, [(eps, min_samples)], rows_per_block, task_rows).drop("config")


def _sweep_scores(df, key, features, labels, width, rows_per_block):
    """Silhouette, number of clusters and share of clustered points per configuration."""
    wide = labels.groupBy(key).agg(
        *[F.max(F.when(F.col("config") == c, F.col("cluster"))).alias(f"l{c}") for c in range(width)]
    )
    names = [f"l{c}" for c in range(width)]
    scored = silhouettes(df.select(key, features).join(wide, key), key, features, names, rows_per_block)
    sizes = labels.groupBy("config").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("cluster") == NOISE).alias("noise"),
    )
    scored = scored.select(F.substring("labeling", 2, 10).cast("int").alias("config"), "clusters", "silhouette")
    return sizes.join(scored, "config", "left").select(
        "config",
        F.coalesce("clusters", F.lit(0)).alias("clusters"),
        "noise",
        (1 - F.col("noise") / F.col("n")).alias("clustered_share"),
        "silhouette",
    )


def dbscan_sweep(
    df: DataFrame,
    key: str,
    features: str,
    eps: list[float],
    min_samples: list[int],
    min_share: float = 0.5,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Score every combination; ``chosen`` marks the best silhouette among the valid ones.

    Valid means at least two clusters and at least ``min_share`` of the points clustered; the
    first of equals (to nine digits, as sums depend on the order of their terms) wins.
    """
    configs = [(e, m) for e in eps for m in min_samples]
    labels = cut_lineage(dbscan_sweep_labels(df, key, features, configs, rows_per_block))
    scores = _sweep_scores(df, key, features, labels, len(configs), rows_per_block)
    named = scores.sparkSession.createDataFrame(
        [(i, float(e), m) for i, (e, m) in enumerate(configs)], "config int, eps double, min_samples int"
    )
    return _chosen(named.join(scores, "config"), min_share)


def _chosen(scores: DataFrame, min_share: float) -> DataFrame:
    """Mark the valid configuration with the best silhouette; one row per configuration."""
    scores = cut_lineage(scores)
    valid = (F.col("clusters") >= 2) & (F.col("clustered_share") >= min_share) & F.col("silhouette").isNotNull()
    best = scores.where(valid).agg(F.min_by("config", F.struct(-F.round("silhouette", 9), F.col("config")))).scalar()
    return scores.withColumn("chosen", F.coalesce(F.col("config") == best, F.lit(False)))


def core_distance(
    df: DataFrame, key: str, features: str, min_samples: int, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """``(key, core)``: distance to the ``min_samples``-th other point."""
    near = knn(df, key, features, min_samples, rows_per_block=rows_per_block)
    return near.where(F.col("rank") == min_samples).select(key, F.col("distance").alias("core"))


def mutual_reachability(
    df: DataFrame, key: str, features: str, min_samples: int, neighbors: int | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Neighbour graph ``(key, neighbor, distance, core_a, core_b, reach)``."""
    near = cut_lineage(knn(df, key, features, neighbors or min_samples, rows_per_block=rows_per_block))
    core = near.where(F.col("rank") == min_samples).select(key, F.col("distance").alias("core"))
    return mutual_distance(near.select(key, "neighbor", "distance"), core, key)


def density_levels(
    df: DataFrame,
    key: str,
    features: str,
    min_samples: int,
    min_cluster_size: int,
    levels: int = 10,
    neighbors: int = 15,
    min_share: float = 0.3,
    rows_per_block: int = ROWS_PER_BLOCK,
    task_rows: int = TASK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Clusters of varying density with noise: ``(labels, scores)``.

    The neighbour graph under mutual reachability is cut at quantiles of its edge lengths; the
    components of at least ``min_cluster_size`` points are the clusters of a level.  ``scores``
    rates the levels by silhouette; the chosen one needs two clusters and ``min_share`` of the
    points.  ``labels`` holds ``(config, key, cluster)`` of every level; without a valid level
    the caller falls back to k-means with two clusters (:func:`density_clusters`).
    """
    edges = cut_lineage(mutual_reachability(df, key, features, min_samples, max(neighbors, min_samples), rows_per_block))
    grid = [(i + 1) / levels for i in range(levels)]
    cuts = quantiles(edges, ["reach"], grid, task_rows=task_rows).first()["q"]
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1)))
    at = F.get(F.array(*[F.lit(c) for c in cuts]), F.col("config"))
    kept = (
        edges.select(F.col(key).alias("u"), F.col("neighbor").alias("v"), "reach")
        .withColumn("config", level)
        .where(F.col("reach") <= at)
    )
    groups = components(kept)
    sizes = groups.groupBy("config", "component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_cluster_size)
    large = groups.join(sizes, ["config", "component"]).select("config", F.col("node").alias("id"), "component")
    numbered = _numbered(large, "config", task_rows).withColumnRenamed("id", key)
    every = df.select(key).withColumn("config", level)
    labels = every.join(numbered, ["config", key], "left").withColumn("cluster", F.coalesce("cluster", F.lit(NOISE)))
    labels = cut_lineage(labels.select("config", key, "cluster"))
    scores = _sweep_scores(df, key, features, labels, levels, rows_per_block)
    named = scores.sparkSession.createDataFrame([(i, float(c)) for i, c in enumerate(cuts)], "config int, level double")
    return labels, _chosen(named.join(scores, "config"), min_share)


def density_clusters(df: DataFrame, key: str, features: str, min_samples: int, min_cluster_size: int, seed: int, **options) -> DataFrame:
    """``(key, cluster)`` of the chosen density level, or of k-means with two clusters when none is valid."""
    labels, scores = density_levels(df, key, features, min_samples, min_cluster_size, **options)
    chosen = scores.where("chosen").select("config").collect()
    if chosen:
        return labels.where(F.col("config") == chosen[0]["config"]).select(key, "cluster")
    from .clusters import kmeans

    return kmeans(df, key, features, 2, [seed])[0].select(key, "cluster")


def density_outlier(labels: DataFrame, core: DataFrame, key: str) -> DataFrame:
    """``(key, cluster, score)``: 1 - smallest core distance of the cluster / own core distance.

    An approximation of the published outlier score: the densest point of a cluster scores 0,
    noise is compared with the densest of all points.
    """
    joined = labels.join(core, key)
    least = joined.groupBy("cluster").agg(F.min("core").alias("least"))
    least = least.withColumn("least", F.when(F.col("cluster") == NOISE, joined.agg(F.min("core")).scalar()).otherwise(F.col("least")))
    ratio = F.coalesce(F.try_divide(F.col("least"), F.col("core")), F.lit(1.0))
    return joined.join(least, "cluster").select(key, "cluster", (1 - ratio).alias("score"))
