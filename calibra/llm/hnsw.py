"""Nearest neighbours by a navigable small-world graph per shard.

Distinct vectors are dealt to shards of bounded size by hash.  One task builds the graph of one
shard: nodes stand in descending order of their level, so the nodes of level l and above are the
first rows of every array, and a level is one flat array of neighbour numbers (-1: none).  Shards
and blocks of queries are single rows; each pair of them is one search, and the answers of all
shards are merged by exact distance.  Insertions and searches run in lockstep for many points,
so the work of a step is a few numpy calls.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.sizing import bounded_rows
from .shared import store
from .vectors import usable

SHARD_ROWS, QUERY_ROWS, MAX_DIMS, MAX_TASKS = 4096, 1024, 1000, 20_000
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 96
_BATCH = 256


def _search(x, near, queries, entries, width):
    """The ``width`` nearest nodes found from ``entries``: numbers and squared distances, nearest first."""
    rows = np.arange(len(queries))
    found = np.full((len(queries), width), -1)
    dist = np.full((len(queries), width), np.inf)
    done = np.ones((len(queries), width), dtype=bool)
    seen = np.zeros((len(queries), len(x)), dtype=bool)
    k = min(width, entries.shape[1])
    found[:, :k], done[:, :k] = entries[:, :k], entries[:, :k] < 0
    dist[:, :k] = np.where(done[:, :k], np.inf, ((x[found[:, :k]] - queries[:, None]) ** 2).sum(axis=2))
    i, j = np.nonzero(~done[:, :k])
    seen[i, found[i, j]] = True
    order = np.argsort(dist, axis=1, kind="stable")
    found, dist, done = (np.take_along_axis(v, order, axis=1) for v in (found, dist, done))
    open_ = rows
    while len(open_):
        at = np.argmin(done[open_], axis=1)
        more = ~done[open_, at]
        open_, at = open_[more], at[more]
        if not len(open_):
            break
        done[open_, at] = True
        next_ = near[found[open_, at]]
        new = (next_ >= 0) & ~seen[open_[:, None], next_]
        i, j = np.nonzero(new)
        far = np.full(next_.shape, np.inf)
        far[i, j] = ((x[next_[i, j]] - queries[open_[i]]) ** 2).sum(axis=1)
        seen[open_[i], next_[i, j]] = True
        all_d = np.concatenate([dist[open_], far], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        dist[open_] = np.take_along_axis(all_d, best, axis=1)
        found[open_] = np.take_along_axis(np.concatenate([found[open_], next_], axis=1), best, axis=1)
        done[open_] = np.take_along_axis(np.concatenate([done[open_], ~new], axis=1), best, axis=1)
    return np.where(np.isfinite(dist), found, -1), dist


def _choose(x, nodes, candidates, dist, most):
    """Up to ``most`` candidates of each node, preferring those nearer to it than to one chosen before."""
    order = np.argsort(dist, axis=1, kind="stable")
    candidates, dist = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(dist, order, axis=1)
    there = np.isfinite(dist)
    points = x[candidates]
    sq = (points**2).sum(axis=2)
    between = sq[:, :, None] + sq[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    chosen, count = np.zeros(dist.shape, dtype=bool), np.zeros(len(dist), dtype=int)
    for j in range(dist.shape[1]):
        blocked = (chosen & (between[:, j] < dist[:, j, None])).any(axis=1)
        take = there[:, j] & ~blocked & (count < most)
        chosen[:, j], count = take, count + take
    # What is left over fills the free places, nearest first.
    rank = np.where(chosen, 0, np.where(there, 1, 2))
    best = np.argsort(rank, axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(there, best, axis=1), np.take_along_axis(candidates, best, axis=1), -1)
    return np.pad(out, ((0, 0), (0, max(0, most - out.shape[1]))), constant_values=-1)


def _link_back(x, near, nodes, most):
    """Give the neighbours of ``nodes`` the way back."""
    i, j = np.nonzero(near[nodes] >= 0)
    to, new = near[nodes[i], j], nodes[i]
    order = np.lexsort((new, to))
    to, new = to[order], new[order]
    first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, dtype=int)
    place = np.arange(len(to)) - np.repeat(first, np.diff(np.r_[first, len(to)]))
    for part in range(0, int(place.max(initial=-1)) + 1, most):
        now = (place >= part) & (place < part + most)
        targets, where = np.unique(to[now], return_inverse=True)
        added = np.full((len(targets), most), -1)
        added[where, place[now] - part] = new[now]
        added[(added[:, :, None] == near[targets][:, None, :]).any(axis=2)] = -1
        all_ = np.concatenate([near[targets], added], axis=1)
        dist = np.where(all_ >= 0, ((x[all_] - x[targets][:, None]) ** 2).sum(axis=2), np.inf)
        near[targets] = _choose(x, targets, all_, dist, most)


def build(x: np.ndarray, seed: int, links: int = LINKS, width: int = BUILD_WIDTH) -> tuple[np.ndarray, list[np.ndarray]]:
    """An order of the rows of ``x``, and per level the neighbours of the first rows in that order."""
    levels = np.floor(-np.log(1 - np.random.default_rng([seed, len(x)]).random(len(x))) / np.log(links)).astype(int)
    order = np.argsort(-levels, kind="stable")
    x, levels = x[order], levels[order]
    sizes = [int((levels >= l).sum()) for l in range(levels[0] + 1)]
    graph = [np.full((n, 2 * links if l == 0 else links), -1) for l, n in enumerate(sizes)]
    at = 1
    while at < len(x):
        level = levels[at]
        end = min(at + max(32, min(_BATCH, at)), sizes[level])
        nodes = np.arange(at, end)
        entries = np.zeros((len(nodes), 1), dtype=int)
        for l in range(levels[0], -1, -1):
            if l > level:
                entries = _search(x, graph[l], x[nodes], entries, 1)[0]
                continue
            found, dist = _search(x, graph[l], x[nodes], entries, width)
            # Points that enter together do not find each other in the graph.
            own = ((x[nodes][:, None] - x[nodes][None, :]) ** 2).sum(axis=2)
            np.fill_diagonal(own, np.inf)
            few = np.argsort(own, axis=1, kind="stable")[:, :width]
            found_all = np.concatenate([found, nodes[few]], axis=1)
            dist_all = np.concatenate([dist, np.take_along_axis(own, few, axis=1)], axis=1)
            graph[l][nodes] = _choose(x, nodes, found_all, dist_all, links)[:, :links] if l else np.pad(
                _choose(x, nodes, found_all, dist_all, links), ((0, 0), (0, links)), constant_values=-1
            )
            _link_back(x, graph[l], nodes, graph[l].shape[1])
            entries = found
        at = end
    return order, graph


def search(x: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, k: int, width: int) -> np.ndarray:
    """Numbers of the ``k`` nearest nodes found, nearest first, -1 where there are no more."""
    entries = np.zeros((len(queries), 1), dtype=int)
    for near in graph[:0:-1]:
        entries = _search(x, near, queries, entries, 1)[0]
    return _search(x, graph[0], queries, entries, max(width, k))[0][:, :k]


def index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS, links: int = LINKS, width: int = BUILD_WIDTH) -> DataFrame:
    """One row per shard of ``vectors (id, x)``: every usable row is in it.

    Copies of a vector are one node with the ``k + 1`` smallest ids, which is all that a list of
    ``k`` neighbours other than the query itself can hold; ranking cuts them before the shuffle.
    """
    rank = F.dense_rank().over(Window.partitionBy("x").orderBy("id"))
    nodes = vectors.withColumn("rank", rank).where(F.col("rank") <= k + 1).groupBy("x")
    nodes = store(nodes.agg(F.array_sort(F.collect_set("id")).alias("ids")), "nodes")
    dims = bounded_rows(nodes.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n")), MAX_DIMS, "dimensions")
    shards = F.create_map(*[F.lit(int(v)) for r in dims for v in (r["dim"], -(-r["n"] // shard_rows))]) if dims else F.lit(None).cast("map<int,int>")
    # Few partitions would hold several shards each, one after the other.
    tasks = min(4 * sum(-(-r["n"] // shard_rows) for r in dims), MAX_TASKS) or 1
    nodes = nodes.withColumn("dim", F.size("x"))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("x"), F.element_at(shards, F.col("dim"))).cast("int"))

    def one(frame):
        frame = frame.sort_values("ids", key=lambda c: c.map(lambda v: v[0]), kind="stable")
        x = np.stack(frame["x"].to_numpy()).astype(np.float64)
        order, graph = build(x, int(frame["shard"].iloc[0]), links, width)
        ids = [np.asarray(v, dtype=np.int64) for v in frame["ids"].to_numpy()[order]]
        return pd.DataFrame(
            {
                "dim": [x.shape[1]],
                "shard": [frame["shard"].iloc[0]],
                "x": [x[order].tobytes()],
                "ids": [np.concatenate(ids).tobytes()],
                "counts": [np.array([len(v) for v in ids], dtype=np.int32).tobytes()],
                "graph": [[level.astype(np.int32).tobytes() for level in graph]],
                "links": [[level.shape[1] for level in graph]],
            }
        )

    schema = "dim int, shard int, x binary, ids binary, counts binary, graph array<binary>, links array<int>"
    return store(nodes.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(one, schema), "hnsw")


def _ask(k, width):
    def run(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                x = np.frombuffer(r.x, dtype=np.float64).reshape(-1, r.dim)
                graph = [np.frombuffer(g, dtype=np.int32).reshape(-1, n) for g, n in zip(r.graph, r.links)]
                ends = np.frombuffer(r.counts, dtype=np.int32).cumsum()
                ids, queries = np.frombuffer(r.ids, dtype=np.int64), np.frombuffer(r.queries, dtype=np.float64).reshape(-1, r.dim)
                found = search(x, graph, queries, k + 1, width)
                out = []
                for q, own, nodes in zip(queries, np.frombuffer(r.query_ids, dtype=np.int64), found):
                    nodes = nodes[nodes >= 0]
                    score = np.sqrt(((x[nodes] - q) ** 2).sum(axis=1))
                    near = [(s, i) for s, n in zip(score, nodes) for i in ids[ends[n - 1] if n else 0 : ends[n]] if i != own]
                    out += [(own, i, s) for s, i in sorted(near)[:k]]
                yield pd.DataFrame(out, columns=["query_id", "id", "score"])

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    links: int = LINKS,
    build_width: int = BUILD_WIDTH,
    search_width: int = SEARCH_WIDTH,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the ``k`` nearest rows found for each query, by Euclidean distance.

    ``score`` is the distance of the original vectors in double precision; ties go to the smaller
    key; a query is never its own neighbour, nor are rows that repeat its key.  Vectors that are
    null, zero, or hold null or non-finite components, and rows without key, take no part; only
    vectors of the query's dimension do.  Of queries that repeat a key the smallest vector is asked.
    With fewer than ``k`` other rows all that are found are given; no rows give no rows.
    """

    def points(df):
        df = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
        return df.where(F.col("id").isNotNull() & usable(F.col("x")))

    shards = index(points(vectors), k, shard_rows, links, build_width)
    number = shards.groupBy("dim").agg(F.max("shard").alias("last"))
    asked = points(queries).groupBy("id").agg(F.min("x").alias("x")).withColumn("dim", F.size("x"))
    parts = -(-asked.count() // query_rows) or 1

    def pack(frame):
        frame = frame.sort_values("id")
        x = np.stack(frame["x"].to_numpy()).astype(np.float64)
        return frame.head(1)[["dim", "part"]].assign(
            queries=[x.tobytes()], query_ids=[frame["id"].to_numpy(dtype=np.int64).tobytes()]
        )

    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    blocks = asked.groupBy("dim", "part").applyInPandas(pack, "dim int, part int, queries binary, query_ids binary")
    # A row per dimension, so at most MAX_DIMS.
    blocks = blocks.join(F.broadcast(number), "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), "last")))
    met = shards.join(blocks, ["dim", "shard"]).drop("last", "part")
    met = met.repartition(F.col("shard"), F.xxhash64("query_ids"))
    found = met.mapInPandas(_ask(k, search_width), "query_id bigint, id bigint, score double")
    best = Window.partitionBy("query_id").orderBy("score", "id")
    out = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").alias(key), "score")
