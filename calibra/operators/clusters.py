"""Centre-based and hierarchical clustering."""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.blocks import ROWS_PER_BLOCK, Blocks, as_points, collapse, coordinates, spread
from ..functions.sizing import bounded_rows, cut_lineage
from ..functions.vectors import element_means, matrix, nearest_center, sq_distances
from .linkage import merged_to
from .neighbors import silhouettes
from .splits import ticket

# Fixed values of the subtractive method: acceptance and rejection shares, the centre limit, the
# radius of a bump, and its factor where a chosen centre lowers the potentials.
ACCEPT, REJECT, MAX_CENTERS, RADIUS, LOWERING = 0.5, 0.15, 26, 1.5, 1.5
# Micro-clusters whose matrix of distances one machine merges (200 MB).
MAX_MICRO = 5000
# Clusters that exact merging leaves to the driver.
LAST_CLUSTERS = 500


def _vectors(df: DataFrame, key: str, features: str) -> DataFrame:
    return df.select(key, features, array_to_vector(F.col(features).cast("array<double>")).alias("__vec"))


def kmeans(df: DataFrame, key: str, features: str, k: int, seeds: list[int], max_iter: int = 300):
    """``(assignment, centers, inertia)`` of the start with the lowest inertia.

    Warns when that start was stopped by ``max_iter``.
    """
    vectors = _vectors(df, key, features).persist()
    best = None
    for seed in seeds:
        model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=1e-4, featuresCol="__vec", predictionCol="cluster").fit(vectors)
        if best is None or model.summary.trainingCost < best.summary.trainingCost:
            best = model
    vectors.unpersist()
    if best.summary.numIter >= max_iter:
        warnings.warn(f"k-means stopped after {max_iter} rounds, before its centers came to rest", stacklevel=2)
    assigned = best.transform(_vectors(df, key, features)).select(key, "cluster")
    return assigned, [list(map(float, c)) for c in best.clusterCenters()], float(best.summary.trainingCost)


def total_inertia(df: DataFrame, features: str) -> DataFrame:
    """Inertia of a single cluster: the total sum of squares, in closed form."""
    size = len(df.select(features).first()[0])
    x = F.col(features)
    parts = [F.count(F.lit(1)) * F.var_pop(x[i].cast("double")) for i in range(size)]
    return df.agg(F.aggregate(F.array(*parts), F.lit(0.0), lambda a, b: a + b).alias("inertia"))


def elbow(df: DataFrame, key: str, features: str, ks: list[int], seeds: list[int], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``(k, inertia, silhouette, best)``; ``best`` marks the highest silhouette, the first of equals.

    One cluster is answered in closed form and has no silhouette.
    """
    rows, tagged = [], df.select(key, features)
    for k in ks:
        if k == 1:
            rows.append((1, float(total_inertia(df, features).first()["inertia"])))
            continue
        assigned, _, cost = kmeans(df, key, features, k, seeds)
        rows.append((k, cost))
        tagged = tagged.join(assigned.withColumnRenamed("cluster", f"k{k}"), key)
    costs = df.sparkSession.createDataFrame(rows, "k int, inertia double")
    names = [f"k{k}" for k in ks if k > 1]
    if not names:
        return costs.withColumns({"silhouette": F.lit(None).cast("double"), "best": F.lit(False)})
    scored = silhouettes(cut_lineage(tagged), key, features, names, rows_per_block)
    scored = scored.select(F.substring("labeling", 2, 10).cast("int").alias("k"), "silhouette")
    table = cut_lineage(costs.join(scored, "k", "left"))
    top = table.where("silhouette is not null").agg(F.min_by("k", F.struct(-F.col("silhouette"), F.col("k")))).scalar()
    return table.withColumn("best", F.coalesce(F.col("k") == top, F.lit(False)))


def align(assigned: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Renumber clusters by their mean label, lowest first, so numbers follow the classes."""
    joined = assigned.join(labels.select(key, label), key)
    means = joined.groupBy("cluster").agg(F.avg(label).alias("m")).orderBy("m", "cluster").collect()
    table = F.create_map(*[F.lit(x) for new, r in enumerate(means) for x in (r["cluster"], new)])
    return joined.select(key, label, table[F.col("cluster")].alias("cluster"))


def kmeans_aligned(df: DataFrame, key: str, features: str, label: str, seeds: list[int], k: int = 2) -> DataFrame:
    """Best of several starts with cluster numbers aligned to the labels: ``(key, label, cluster)``."""
    assigned, _, _ = kmeans(df, key, features, k, seeds)
    return align(assigned, df, key, label)


def lloyd_step(df: DataFrame, features: str, centers) -> DataFrame:
    """One assignment and update from the given centers: ``(cluster, n, center)``."""
    assigned = df.select(F.col(features).cast("array<double>").alias("x")).withColumn("cluster", nearest_center("x", centers)["cluster"])
    return element_means(assigned, ["cluster"], "x", len(centers[0]))


# --- fuzzy c-means ----------------------------------------------------------------------


def _memberships(rows: np.ndarray, centers: np.ndarray, m: float) -> np.ndarray:
    """Membership of each row in each center; the distance is kept off zero."""
    sq = np.stack([((rows - c) ** 2).sum(axis=1) for c in centers], axis=1)
    dist = np.fmax(np.sqrt(sq), np.finfo(np.float64).eps)
    w = dist ** (-2.0 / (m - 1.0))
    return w / w.sum(axis=1, keepdims=True)


def fuzzy_step(df: DataFrame, features: str, centers, m: float = 2.0, previous=None) -> DataFrame:
    """``(cluster, weight, center, change)`` after one update from ``centers``.

    Each task sums its rows to one row per center, so a round moves a few numbers only.
    ``change`` is the squared change of the memberships since ``previous`` centers.
    """
    now = np.asarray(centers, dtype=np.float64)
    before = None if previous is None else np.asarray(previous, dtype=np.float64)
    size = now.shape[1]

    def partial(batches):
        total, weight, change = np.zeros(now.shape), np.zeros(len(now)), np.zeros(len(now))
        for pdf in batches:
            if not len(pdf):
                continue
            rows = matrix(pdf["x"])
            u = _memberships(rows, now, m)
            um = u**m
            total += um.T @ rows
            weight += um.sum(axis=0)
            if before is not None:
                change += ((u - _memberships(rows, before, m)) ** 2).sum(axis=0)
        yield pd.DataFrame({"cluster": np.arange(len(now)), "weight": weight, "total": list(total), "change": change})

    points = df.select(F.col(features).cast("array<double>").alias("x"))
    sums = points.mapInPandas(partial, "cluster int, weight double, total array<double>, change double")
    return sums.groupBy("cluster").agg(
        F.sum("weight").alias("weight"),
        F.array(*[F.try_divide(F.sum(F.col("total")[i]), F.sum("weight")) for i in range(size)]).alias("center"),
        F.sum("change").alias("change"),
    )


def fuzzy_cmeans(
    df: DataFrame, key: str, features: str, c: int, seed: int, m: float = 2.0, error: float = 0.005, max_iter: int = 1000
):
    """``(assignment, centers)``: memberships ``u`` and the hard cluster of the largest one.

    Rounds stop when the memberships change by less than ``error`` in total (root of the summed
    squares); a warning says that ``max_iter`` came first.  The first centers are ``c`` rows in
    seeded order.
    """
    # Every round reads the points again, so they are written once.
    df = cut_lineage(df.select(key, features))
    x = F.col(features).cast("array<double>").alias("x")
    # Center sized, read once: c rows.
    centers = np.array([r["x"] for r in df.select(x, key).orderBy(ticket(key, seed)).limit(c).collect()])
    previous = None
    for _ in range(max_iter):
        rows = sorted(fuzzy_step(df, features, centers, m, previous).collect(), key=lambda r: r["cluster"])
        if previous is not None and sum(r["change"] for r in rows) ** 0.5 < error:
            break
        previous, centers = centers, np.array([r["center"] for r in rows])
    else:
        warnings.warn(f"fuzzy c-means stopped after {max_iter} rounds, before its memberships came to rest", stacklevel=2)
    return fuzzy_assign(df, key, features, centers, m), centers.tolist()


def fuzzy_assign(df: DataFrame, key: str, features: str, centers, m: float = 2.0) -> DataFrame:
    """``(key, u, cluster)`` for given centers."""
    table = np.asarray(centers, dtype=np.float64)

    @F.pandas_udf("u array<double>, cluster int")
    def assign(x: pd.Series) -> pd.DataFrame:
        u = _memberships(matrix(x), table, m)
        return pd.DataFrame({"u": list(u), "cluster": u.argmax(axis=1).astype("int32")})

    placed = df.select(key, assign(F.col(features).cast("array<double>")).alias("a"))
    return placed.select(key, F.col("a")["u"].alias("u"), F.col("a")["cluster"].alias("cluster"))


def fuzzy_select(df: DataFrame, key: str, features: str, cs: list[int], seed: int, rows_per_block: int = ROWS_PER_BLOCK):
    """Fit every number of clusters and keep the highest silhouette: ``(scores, assignment)``."""
    tagged, fits = df.select(key, features), {}
    for c in cs:
        fits[c], _ = fuzzy_cmeans(df, key, features, c, seed)
        tagged = tagged.join(fits[c].select(key, F.col("cluster").alias(f"c{c}")), key)
    scored = silhouettes(cut_lineage(tagged), key, features, [f"c{c}" for c in cs], rows_per_block)
    scores = cut_lineage(scored.select(F.substring("labeling", 2, 10).cast("int").alias("c"), "clusters", "silhouette"))
    best = scores.orderBy(F.desc_nulls_last("silhouette"), "c").first()["c"]
    return scores, fits[best]


# --- subtractive clustering -------------------------------------------------------------


def potentials(
    df: DataFrame, key: str, features: str, ra: float, rows_per_block: int = ROWS_PER_BLOCK, reach: float | None = None
) -> DataFrame:
    """``(id, x, w, potential)`` per distinct point: the sum of Gaussian bumps of all points.

    With ``reach`` cells that are farther apart than that many radii do not meet.  Each point left
    out has a bump below ``exp(-4 * reach ** 2)`` (2.4e-16 at three radii), so a potential is short
    by at most that much times the number of points.
    """
    blocks = Blocks.build(collapse(as_points(df, key, features), key), rows_per_block)
    scale = (ra / 2.0) ** 2

    def bump(mine: list[pd.DataFrame], theirs: list[pd.DataFrame], met: list[list[int]]) -> pd.DataFrame:
        # A pair of blocks meets once and serves both; a block meets itself as one object.
        sums = {id(f): np.zeros(len(f)) for f in [*mine, *theirs]}
        for left, others in zip(mine, met):
            for right in (theirs[j] for j in others):
                height = sq_distances(coordinates(left), coordinates(right))
                height /= -scale
                np.exp(height, out=height)
                sums[id(left)] += height @ right["w"].to_numpy().astype(float)
                if left is not right:
                    sums[id(right)] += left["w"].to_numpy().astype(float) @ height
        out = [pd.DataFrame({"id": [], "p": []})]
        out += [pd.DataFrame({"id": f["id"].to_numpy(), "p": sums[id(f)]}) for f in (mine if mine is theirs else [*mine, *theirs])]
        return pd.concat([o for o in out if len(o)] or out, ignore_index=True)

    slim = blocks.points.select("id", "x", "w", "cell", "lot")
    id_type = blocks.points.schema["id"].dataType.simpleString()
    near = blocks.within(blocks, None if reach is None else reach * ra)
    parts = blocks.meet(blocks, near, bump, f"id {id_type}, p double", left=slim, right=slim, half=True, sweep=True)
    sums = parts.groupBy("id").agg(F.sum("p").alias("potential"))
    return slim.drop("cell", "lot").join(sums, "id")


def subtractive(
    df: DataFrame, key: str, features: str, ra: float = RADIUS, rb_factor: float = LOWERING,
    accept: float = ACCEPT, reject: float = REJECT, rows_per_block: int = ROWS_PER_BLOCK,
    max_centers: int = MAX_CENTERS, reach: float | None = None,
):
    """``(assignment, centers)`` by repeated choice of the highest potential.

    The first centre is the highest potential; each centre lowers the potentials around it; the
    rule stops below ``accept`` of the first potential (below ``reject`` even for the first) or
    after ``max_centers``, which is warned of.  ``reach`` as in :func:`potentials`.  The acceptance test makes the rejection band ineffective after the first
    centre; the rule is kept as it is defined.  Ties go to the smallest key.
    """
    base = cut_lineage(potentials(df, key, features, ra, rows_per_block, reach))
    scale = (ra * rb_factor / 2.0) ** 2
    centers, peaks, first = [], [], None
    while len(centers) < max_centers:
        now = base
        if centers:
            table, heights = np.array(centers), np.array(peaks)

            @F.pandas_udf("double")
            def lowered(x: pd.Series) -> pd.Series:
                return pd.Series(np.exp(-sq_distances(matrix(x), table) / scale) @ heights)

            now = base.withColumn("potential", F.col("potential") - lowered("x"))
        top = now.agg(F.min(F.struct((-F.col("potential")).alias("p"), F.col("id"), F.col("x"))).alias("t")).first()["t"]
        peak = -top["p"]
        first = peak if first is None else first
        if peak < reject * first or (centers and peak < accept * first):
            break
        centers.append(list(top["x"]))
        peaks.append(peak)
    else:
        warnings.warn(f"subtractive clustering stopped at its limit of {max_centers} centres", stacklevel=2)
    assigned = df.select(key, nearest_center(F.col(features).cast("array<double>"), centers)["cluster"].alias("cluster"))
    return assigned, centers


# --- hierarchical merging of micro-clusters ---------------------------------------------


def micro_clusters(df: DataFrame, key: str, features: str, m: int, seed: int, max_iter: int = 20) -> DataFrame:
    """``(key, x, micro)``: at most ``m`` small k-means clusters to be merged afterwards.

    They need not have come to rest; a warning says when ``max_iter`` ended them.
    """
    assigned, _, _ = kmeans(df, key, features, m, [seed], max_iter=max_iter)
    points = df.select(key, F.col(features).cast("array<double>").alias("x"))
    return cut_lineage(points.join(assigned.withColumnRenamed("cluster", "micro"), key))


def _micro_distances(micro: DataFrame, key: str, linkage: str, rows_per_block: int, max_micro: int = MAX_MICRO):
    """Sizes and the exact linkage distances between micro-clusters, as small matrices; too many fail loudly."""
    size = len(micro.select("x").first()[0])
    stats = sorted(bounded_rows(element_means(micro, ["micro"], "x", size), max_micro, "micro-clusters"), key=lambda r: r["micro"])
    names = [r["micro"] for r in stats]
    n = np.array([r["n"] for r in stats], dtype=float)
    if linkage == "ward":
        centers = np.array([r["center"] for r in stats])
        return names, n, np.sqrt(2.0 * np.outer(n, n) / (n[:, None] + n[None, :]) * sq_distances(centers, centers))
    blocks = Blocks.build(collapse(micro, key, ["micro"]), rows_per_block)

    def reduce(mine: list[pd.DataFrame], theirs: list[pd.DataFrame], met: list[list[int]]) -> pd.DataFrame:
        out = [pd.DataFrame({"a": [], "b": [], "s": [], "m": []})]
        for left, others in zip(mine, met):
            for right in (theirs[j] for j in others):
                dist = np.sqrt(sq_distances(coordinates(left), coordinates(right)))
                (ia, a), (ib, b) = (np.unique(f["micro"].to_numpy(), return_inverse=True) for f in (left, right))
                # Sums over the pairs of two micro-clusters are two products with their members.
                members = [np.zeros((len(f), len(names))) for f, names in ((left, ia), (right, ib))]
                for held, at, f in zip(members, (a, b), (left, right)):
                    held[np.arange(len(at)), at] = f["w"].to_numpy()
                sums, tops = members[0].T @ (dist @ members[1]), np.zeros((len(ia), len(ib)))
                if linkage != "average":
                    rows, cols = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
                    starts = [np.searchsorted(v, np.arange(v.max() + 1)) for v in (a[rows], b[cols])]
                    tops = np.maximum.reduceat(np.maximum.reduceat(dist[np.ix_(rows, cols)], starts[0], axis=0), starts[1], axis=1)
                out.append(pd.DataFrame({"a": np.repeat(ia, len(ib)), "b": np.tile(ib, len(ia)), "s": sums.ravel(), "m": tops.ravel()}))
                if left is not right:
                    # A pair of blocks meets once and serves both.
                    out.append(out[-1].rename(columns={"a": "b", "b": "a"})[["a", "b", "s", "m"]])
            out = [put_together(pd.concat([o for o in out if len(o)] or out, ignore_index=True))]
        return out[0]

    def put_together(found: pd.DataFrame) -> pd.DataFrame:
        return found.groupby(["a", "b"], as_index=False, sort=False).agg({"s": "sum", "m": "max"})

    slim = blocks.points.select("x", "w", "micro", "cell", "lot")
    pairs = blocks.meet(blocks, blocks.within(blocks), reduce, "a int, b int, s double, m double", left=slim, right=slim, half=True, sweep=True)
    # One row per pair of micro-clusters: bounded by m squared.
    rows = pairs.groupBy("a", "b").agg(F.sum("s").alias("s"), F.max("m").alias("m")).collect()
    at = {v: i for i, v in enumerate(names)}
    dist = np.zeros((len(names), len(names)))
    for r in rows:
        i, j = at[r["a"]], at[r["b"]]
        dist[i, j] = r["s"] / (n[i] * n[j]) if linkage == "average" else r["m"]
    return names, n, dist


def _merge(n: np.ndarray, dist: np.ndarray, linkage: str) -> list[tuple[int, int, float, int]]:
    """Merge the two nearest groups until one is left: ``(left, right, distance, size)`` per step.

    Every group remembers its nearest one of higher number, so a step looks at one row and at the
    groups that lose their nearest: quadratic in all.  Of equal distances the first pair is merged.
    """
    n, dist = n.astype(float).copy(), dist.astype(float).copy()
    count, ids, steps = len(n), list(range(len(n))), []
    np.fill_diagonal(dist, np.inf)
    after = np.arange(count)[None, :] > np.arange(count)[:, None]
    near = np.where(after, dist, np.inf).argmin(axis=1) if count else np.empty(0, dtype=int)
    least = np.where(after[np.arange(count), near], dist[np.arange(count), near], np.inf) if count else np.empty(0)
    alive = np.ones(count, dtype=bool)

    def look(i):
        row = dist[i, i + 1 :]
        near[i] = i + 1 + int(row.argmin()) if len(row) else i
        least[i] = row.min(initial=np.inf)

    for _ in range(count - 1):
        a = int(least.argmin())
        b = int(near[a])
        d = dist[a, b]
        steps.append((min(ids[a], ids[b]), max(ids[a], ids[b]), float(d), int(n[a] + n[b])))
        others = alive.copy()
        others[[a, b]] = False
        if linkage == "ward":
            total = n[a] + n[b] + n
            new = np.sqrt(np.maximum(((n[a] + n) * dist[a] ** 2 + (n[b] + n) * dist[b] ** 2 - n * d * d) / total, 0.0))
        elif linkage == "average":
            new = (n[a] * dist[a] + n[b] * dist[b]) / (n[a] + n[b])
        else:
            new = np.maximum(dist[a], dist[b])
        dist[a, others] = dist[others, a] = new[others]
        dist[b, :] = dist[:, b] = np.inf
        alive[b], least[b] = False, np.inf
        n[a] += n[b]
        ids[a] = count + len(steps) - 1
        lost = alive & ((near == a) | (near == b)) & (np.arange(count) < b)
        for i in {a, *np.flatnonzero(lost).tolist()}:
            look(i)
        closer = alive & (np.arange(count) < a) & ((dist[:, a] < least) | ((dist[:, a] == least) & (a < near)))
        near[closer], least[closer] = a, dist[closer, a]
    return steps


def merge_table(
    micro: DataFrame, key: str, linkage: str = "ward", rows_per_block: int = ROWS_PER_BLOCK, max_micro: int = MAX_MICRO
) -> DataFrame:
    """``(step, left, right, distance, size)``: the merges behind a dendrogram of at most ``max_micro`` micro-clusters."""
    _, n, dist = _micro_distances(micro, key, linkage, rows_per_block, max_micro)
    rows = [(i + 1, *step) for i, step in enumerate(_merge(n, dist, linkage))]
    return micro.sparkSession.createDataFrame(rows, "step int, left int, right int, distance double, size bigint")


def micro_agglomerative(
    df: DataFrame, key: str, features: str, linkage: str, ks: list[int], m: int | None, seed: int,
    rows_per_block: int = ROWS_PER_BLOCK,
):
    """``(scores, assignment)`` of the best number of clusters by silhouette.

    With ``m=None`` all rows are merged, exactly (``linkage.py``).  Otherwise rows become at most ``m`` micro-clusters, whose small table is merged.  Ward distances come
    from sizes and means, average and complete ones from exact pair sums and maxima, so every
    linkage is exact given the micro-clusters, and exact altogether when ``m`` equals the rows.
    """
    scores, assigned = best_linkage(df, key, features, [linkage], ks, m, seed, rows_per_block)
    return scores.select("k", "silhouette"), assigned


def best_linkage(
    df: DataFrame, key: str, features: str, linkages: list[str], ks: list[int], m: int | None, seed: int,
    rows_per_block: int = ROWS_PER_BLOCK, max_micro: int = MAX_MICRO, last: int = LAST_CLUSTERS,
):
    """``(scores, assignment)`` of the best linkage and number of clusters by silhouette, from one set of micro-clusters.

    ``scores`` is ``(linkage, k, silhouette, chosen)``; all cuts of all merges are scored in one sweep.
    Of equal scores the first linkage and the fewest clusters win.  With ``m=None`` there are no
    micro-clusters: all rows are merged, by rounds down to ``last`` clusters and then by the driver.
    """
    cuts = [(linkage, k) for linkage in linkages for k in ks]
    micro = wide = _merged_rows(df, key, features, linkages, max(ks), last, rows_per_block) if m is None else micro_clusters(df, key, features, m, seed)
    for i, linkage in enumerate(linkages):
        if m is None:
            micro = wide.withColumn("micro", F.col(f"m{i}"))
            wide = wide.withColumn("micro", F.col(f"m{i}"))
        names, n, dist = _micro_distances(micro, key, linkage, rows_per_block, max_micro)
        steps = _merge(n, dist, linkage)
        for j, k in enumerate(ks):
            groups = _cut(len(names), steps, k)
            table = F.create_map(*[F.lit(v) for at, name in enumerate(names) for v in (name, groups[at])])
            wide = wide.withColumn(f"c{i * len(ks) + j}", table[F.col("micro")])
    scored = silhouettes(wide, key, "x", [f"c{i}" for i in range(len(cuts))], rows_per_block)
    scored = {int(r["labeling"][1:]): r["silhouette"] for r in scored.collect()}  # a row for each cut
    best = min(range(len(cuts)), key=lambda i: (scored[i] is None, -round(scored[i] or 0.0, 9), linkages.index(cuts[i][0]), cuts[i][1]))
    rows = [(*cut, scored[i], i == best) for i, cut in enumerate(cuts)]
    scores = wide.sparkSession.createDataFrame(rows, "linkage string, k int, silhouette double, chosen boolean")
    return scores, wide.select(key, F.col(f"c{best}").alias("cluster"))


def _merged_rows(df: DataFrame, key: str, features: str, linkages: list[str], k: int, last: int, rows_per_block: int) -> DataFrame:
    """``(key, x, m0, m1, ..)``: for every linkage the clusters of all rows that exact merging leaves, numbered from 0."""
    points = as_points(df, key, features)
    nodes = cut_lineage(collapse(points, key).withColumn("node", F.monotonically_increasing_id()))
    held = nodes
    for i, linkage in enumerate(linkages):
        found = merged_to(nodes, linkage, max(last, 2 * k + 3), k - 1, rows_per_block)
        # At most ``last`` clusters, or twice the cuts asked for.
        names = found.select("c").distinct().withColumn(f"m{i}", (F.row_number().over(Window.orderBy("c")) - 1).cast("int"))
        held = held.join(found.join(F.broadcast(names), "c").drop("c"), "node")
    return cut_lineage(spread(points, key, held, [f"m{i}" for i in range(len(linkages))]))


def _cut(count: int, steps, k: int) -> list[int]:
    """Group number of each leaf after all but the last ``k - 1`` merges."""
    group = {i: [i] for i in range(count)}
    for at, (a, b, _, _) in enumerate(steps[: max(count - k, 0)]):
        group[count + at] = group.pop(a) + group.pop(b)
    out = [0] * count
    for number, members in enumerate(sorted(group.values(), key=min)):
        for leaf in members:
            out[leaf] = number
    return out
