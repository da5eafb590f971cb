"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Equal fingerprints are collapsed first.  The distinct ones are cut into tiles by population count
(two fingerprints within the radius differ in it by no more than the radius), and large counts
further by hash.  Two tiles meet in one task, which compares them by exclusive-or and bit counts
in numpy.  Inside, the rows are ordered by the counts of their four 16-bit words, and blocks whose
counts cannot come within the radius are skipped.  A pair of tiles gives a spanning forest of its
links, never the links themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import fresh, store

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE_ROWS = 65_536
_BLOCK, _STRIP = 128, 4096
_HASHES_AT_ONCE = 65_536
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint as an unsigned 64-bit number; a missing text or one without words gives zero."""
    # Without an argument, split() cuts at exactly 0x20 and 0x09 to 0x0D.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - shingle, 0) + 1
    starts, ends = starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    bits = np.zeros(64, dtype=np.int64)
    for i in range(0, last, _HASHES_AT_ONCE):
        spans = zip(starts[i : i + _HASHES_AT_ONCE], ends[i : i + _HASHES_AT_ONCE])
        h = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(key, fp)`` for every row, ``fp`` as a signed 64-bit integer."""

    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        values = np.fromiter((simhash(t, shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(values.view(np.int64))

    return docs.select(F.col(key).alias("key"), fingerprint.asNondeterministic()(F.col(text)).alias("fp"))


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the ends of the links ``a``-``b`` in ``parent``, which always points to roots."""
    while True:
        a, b = parent[a], parent[b]
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _words(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int64)


def _boxes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(0, len(counts), _BLOCK)
    return np.minimum.reduceat(counts, at, axis=0), np.maximum.reduceat(counts, at, axis=0)


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of ``left`` followed by ``right``) and the roots of their links; ``right`` None: ``left`` with itself."""
    order = np.lexsort(_words(left).T)
    a, places_a, same = left[order], order, right is None
    if same:
        b, places_b = a, order
    else:
        order = np.lexsort(_words(right).T)
        b, places_b = right[order], order + len(left)
    (low_a, high_a), (low_b, high_b) = _boxes(_words(a)), _boxes(_words(b))
    parent = np.arange(len(left) + (0 if same else len(right)))
    for i in range(len(low_a)):
        gap = np.maximum(np.maximum(low_b - high_a[i], low_a[i] - high_b), 0).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        if same:
            near = near[near >= i]
        columns = (near[:, None] * _BLOCK + np.arange(_BLOCK)).ravel()
        columns = columns[columns < len(b)]
        rows = a[i * _BLOCK : (i + 1) * _BLOCK, None]
        for j in range(0, len(columns), _STRIP):
            strip = columns[j : j + _STRIP]
            x, y = np.nonzero(np.bitwise_count(rows ^ b[strip][None, :]) <= radius)
            if len(x):
                unite(parent, places_a[i * _BLOCK + x], places_b[strip[y]])
    linked = np.flatnonzero(parent != np.arange(len(parent)))
    return linked, parent[linked]


def links(distinct: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``(a, b)`` between the nodes of ``distinct (fp, node)`` that connect what lies within ``radius`` bits."""
    distinct = distinct.withColumn("c", F.bit_count("fp").cast("int"))
    # One row per population count, 65 at most.
    sizes = {r["c"]: r["n"] for r in distinct.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [-(-sizes.get(c, 0) // tile_rows) for c in range(65)]
    number = F.array(*[F.lit(p) for p in parts])

    def pack(frame):
        order = np.argsort(frame["fp"].to_numpy(), kind="stable")
        return frame.head(1)[["c", "s"]].assign(
            fps=frame["fp"].to_numpy()[order].tobytes(), nodes=frame["node"].to_numpy()[order].tobytes()
        )

    tiles = (
        distinct.withColumn("s", F.pmod(F.xxhash64("fp"), F.get(number, F.col("c"))).cast("int"))
        .groupBy("c", "s")
        .applyInPandas(pack, "c int, s int, fps binary, nodes binary")
    )
    tiles = store(tiles, "tiles")

    def partners(low, high, c, s):
        other = tiles.withColumn(c, F.explode(F.sequence(F.greatest(F.lit(0), low), F.least(F.lit(64), high))))
        other = other.where(F.get(number, F.col(c)) > 0)
        return other.withColumn(s, F.explode(F.sequence(F.lit(0), F.get(number, F.col(c)) - 1)))

    pair = ["lc", "ls", "rc", "rs"]
    left = partners(F.col("c"), F.col("c") + radius, "rc", "rs").where("rc > c or rs >= s")
    left = left.select(F.col("c").alias("lc"), F.col("s").alias("ls"), "rc", "rs", "fps", "nodes")
    right = partners(F.col("c") - radius, F.col("c"), "lc", "ls").where("lc < c or ls < s")
    right = right.select("lc", "ls", F.col("c").alias("rc"), F.col("s").alias("rs"), F.col("fps").alias("fps2"), F.col("nodes").alias("nodes2"))
    own = F.expr("lc = rc and ls = rs")
    met = left.join(right, pair, "left").where(own | F.col("fps2").isNotNull()).select("fps", "nodes", "fps2", "nodes2")

    def compare(frames):
        for frame in frames:
            for fps, nodes, fps2, nodes2 in frame.itertuples(index=False):
                ids = [np.frombuffer(x, dtype=np.int64) for x in (nodes, nodes2) if x is not None]
                other = None if fps2 is None else np.frombuffer(fps2, dtype=np.uint64)
                x, y = forest(np.frombuffer(fps, dtype=np.uint64), other, radius)
                ids = np.concatenate(ids)
                yield type(frame)({"a": ids[x], "b": ids[y]})

    return met.mapInPandas(compare, "a bigint, b bigint")


def simhash_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """``(key, fp, component_id)`` for every row; ``component_id`` is the smallest key reachable by links.

    Two documents link when their fingerprints differ in at most ``radius`` bits; a missing or
    empty text has fingerprint zero and links like any other.  Rows that repeat a key are one
    document: their links are joined.  A row without a key links with nothing and has no
    component.  No rows give no rows; other columns of ``docs`` are not read.
    """
    rows = store(fingerprints(docs, key, text, shingle), "fingerprints")
    distinct = store(
        rows.where("key is not null").groupBy("fp").agg(F.min(F.col("key").cast("bigint")).alias("node")), "distinct"
    )
    # Rows of one key with several texts carry one node in several fingerprints.
    again = rows.where("key is not null").groupBy(F.col("key").cast("bigint").alias("a")).agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
    again = again.where("x != y").select("a").join(rows.select(F.col("key").cast("bigint").alias("a"), "fp"), "a")
    again = again.join(distinct, "fp").select("a", F.col("node").alias("b"))
    labels = components(links(distinct, radius, tile_rows).unionByName(again))
    named = store(
        distinct.join(labels, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id")),
        "components",
    )
    keyed, bare = rows.where("key is not null"), rows.where("key is null")
    out = keyed.join(named, "fp", "left").select("key", "fp", "component_id")
    return out.unionByName(bare.withColumn("component_id", F.lit(None).cast("bigint"))).withColumnRenamed("key", key)


def simhash_dedup(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest key, and one row of it.

    Rows without a key stay.
    """
    kept, = fresh(docs, "__kept")
    found = simhash_components(docs, key, **options)
    ids = store(found.where(F.col(key).cast("bigint") == F.col("component_id")).select(F.col(key).alias(kept)).distinct(), "kept")
    stay = docs.join(ids, docs[key] == ids[kept], "left_semi").dropDuplicates([key])
    return stay.unionByName(docs.where(F.col(key).isNull()))
