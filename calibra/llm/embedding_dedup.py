"""Near-duplicate embeddings: random-hyperplane signs in several tables, exact cosines, components.

Equal vectors are collapsed first.  In each table the signs of ``bits`` projections are the bucket
of a vector.  Buckets of one member are dropped before any vector moves; large buckets are cut into
blocks that meet pairwise.  A pair that collides in several tables is counted in the first of them
only, so each task adds up links per vector and gives a spanning forest, never the pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import store
from .simhash import unite
from .vectors import usable

# At a cosine of 0.98 one bit agrees with probability 0.936: a pair is missed by all tables once in 5,000.
BITS, TABLES, SEED = 16, 20, 7
BLOCK_ROWS = 1024


def hyperplanes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def _signed(distinct: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    def run(frames):
        planes = {}
        for frame in frames:
            sigs, packed = [], []
            for x in frame["x"]:
                x = np.asarray(x, dtype=np.float64)
                if len(x) not in planes:
                    planes[len(x)] = hyperplanes(len(x), bits, tables, seed)
                on = (x @ planes[len(x)] > 0).reshape(tables, bits)
                sigs.append((on @ (1 << np.arange(bits))).astype(np.int32))
                packed.append(x.tobytes())
            yield frame.drop(columns="x").assign(v=packed, sigs=sigs)

    distinct = distinct.select("node", "h", "label", "w", "x")
    return distinct.mapInPandas(run, "node bigint, h bigint, label string, w bigint, v binary, sigs array<int>")


def _meet(threshold: float):
    """Links between the blocks ``l`` and ``r`` of a bucket, or within ``l`` where the blocks are one."""

    def side(nodes, h, w, v, sigs):
        x = np.stack([np.frombuffer(b, dtype=np.float64) for b in v])
        # Scaling first keeps products of very large components finite.
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return np.asarray(nodes), np.asarray(h), np.asarray(w), x, np.linalg.norm(x, axis=1), np.stack(sigs)

    def run(frames):
        for frame in frames:
            for t, s, r, rows in zip(frame["t"], frame["s"], frame["r"], frame["rows"]):
                blocks = np.array([m["b"] for m in rows])
                nodes, h, w, x, norm, sigs = side(*([m[k] for m in rows] for k in ("node", "h", "w", "v", "sigs")))
                left, right = np.flatnonzero(blocks == s), np.flatnonzero(blocks == r)
                if not len(left) or not len(right):
                    continue
                cosine = (x[left] @ x[right].T) / (norm[left][:, None] * norm[right][None, :])
                i, j = np.nonzero(cosine >= threshold)
                i, j = left[i], right[j]
                if s == r:
                    i, j = i[i < j], j[i < j]
                new = ~(sigs[i, :t] == sigs[j, :t]).any(axis=1)
                i, j = i[new], j[new]
                if not len(i):
                    continue
                links = np.bincount(i, w[j], len(nodes)) + np.bincount(j, w[i], len(nodes))
                parent = np.arange(len(nodes))
                unite(parent, i, j)
                on = np.flatnonzero(links)
                yield pd.DataFrame({"a": nodes[on], "h": h[on], "b": nodes[parent[on]], "links": links[on].astype(np.int64)})

    return run


def links(signed: DataFrame, threshold: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(a, h, b, links)``: links of vector ``(a, h)`` found in one task, and a node ``b`` it is connected with."""
    bucket = ["label", "dim", "t", "sig"]
    members = signed.select(
        "node", "h", "label", F.length("v").alias("dim"), F.posexplode("sigs").alias("t", "sig")
    )
    shared = store(
        members.groupBy(*bucket)
        .agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n"),
        "buckets",
    )
    placed = members.join(shared, bucket).withColumn("b", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    placed = store(placed, "placed")
    # A block meets itself and every other block of its bucket; the smaller number comes first.
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node", "h", *bucket, "b", F.least("b", "other").alias("s"), F.greatest("b", "other").alias("r")
    )
    full = pairs.join(signed.select("node", "h", "w", "v", "sigs"), ["node", "h"])
    met = full.groupBy(*bucket, "s", "r").agg(F.collect_list(F.struct("b", "node", "h", "w", "v", "sigs")).alias("rows"))
    return met.select("t", "s", "r", "rows").mapInPandas(_meet(threshold), "a bigint, h bigint, b bigint, links bigint")


def embedding_components(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    bits: int = BITS,
    tables: int = TABLES,
    seed: int = SEED,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row.

    Rows of one label (not null) and one dimension whose cosine, in double precision, is at least
    ``threshold`` are linked when they share a bucket in some table.  ``n_links`` counts the other
    rows linked directly, ``component_id`` is the smallest key reachable.  A vector that is null,
    zero, or holds null or non-finite components, and one without label, links with nothing; so does
    one without key, whose component is null and which is not kept.  Rows that repeat a key are
    counted each, and each has the component of its own vector.  Other columns are not read.
    """
    rows = vectors.select(
        F.col(key).cast("bigint").alias("key"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("x"),
    )
    rows = rows.withColumn("ok", usable(F.col("x")) & F.col("key").isNotNull() & F.col("label").isNotNull())
    valid, rest = rows.where("ok").drop("ok"), rows.where("not ok")
    distinct = valid.groupBy(F.xxhash64("x").alias("h"), "x", "label").agg(F.min("key").alias("node"), F.count(F.lit(1)).alias("w"))
    signed = store(_signed(distinct, bits, tables, seed), "signed")
    found = store(links(signed, threshold, block_rows), "links")
    labels = components(found.select("a", "b"))
    degree = found.groupBy(F.col("a").alias("node"), "h").agg(F.sum("links").alias("links"))
    named = store(
        distinct.join(degree, ["node", "h"], "left")
        .join(labels, "node", "left")
        .select(
            "h",
            "x",
            "label",
            (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ),
        "named",
    )
    done = valid.withColumn("h", F.xxhash64("x")).join(named, ["h", "x", "label"]).select("key", "n_links", "component_id")
    rest = rest.select("key", F.lit(0).cast("bigint").alias("n_links"), F.col("key").alias("component_id"))
    out = done.unionByName(rest).withColumn("kept", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)))
    return out.withColumnRenamed("key", key)
