"""Ranked lexical search over buckets of impact vectors in the order of their lengths.

A document is a vector of integer impacts, one for each term, an item a vector of integer term weights,
and a score is their inner product.  Only terms of the items matter, so a document keeps those alone.

1. Documents are split into terms once; the terms of the items are counted and stored in packed form.
   Statistics of the collection come from the stored table.
2. Impact vectors are range-partitioned and sorted by length (Euclidean norm), the longest first.
3. The longest ones are searched first.  The k-th best score of each item found there is its
   threshold, and no vector shorter than the least ``threshold / length of item`` is read again.
4. A task goes through its vectors in buckets of like length.  Cauchy-Schwarz drops the items a
   bucket cannot serve.  For the others the heaviest coordinates are looked up until the rest of the
   item, by the greatest impact of each coordinate in the bucket or by the lengths of the rests, cannot
   reach the threshold; a vector whose sum so far plus that bound stays below it is dropped.
5. What survives is scored again in integers over all its terms.  Thresholds rise as results come in.

Items are taken in blocks of ``block_bytes`` of text; every block meets all documents.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .shared import slices, store

K, BLOCK_BYTES, BUCKET_ROWS, FIRST_SHARE = 20, 8 << 20, 2048, 1 / 32
# ASCII letters in lower case and digits stay, all other ASCII separates; bytes of longer code points stay.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
# Bounds are floating point, scores are not.
_SLACK = 1 - 1e-9
# Stands last among equal scores.
_NULL_KEY = (1 << 63) - 1


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TERM_BYTES).split()


def impacts_of(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Impact of each term of documents with ``n`` terms, in 64-bit integers."""
    m = 75 + (25 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight_of(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Items:
    """Term weights of a block of items, the heaviest parts findable by item."""

    def __init__(self, counts: list[Counter], weights: np.ndarray):
        used = [(np.array(sorted(c), dtype=np.int64), c) for c in counts]
        kept = [t[weights[t] > 0] for t, _ in used]
        self.terms = kept
        self.values = [weights[t] * np.array([c[i] for i in t.tolist()], dtype=np.int64) for t, (_, c) in zip(kept, used)]
        self.norms = np.array([math.sqrt(float((v.astype(np.float64) ** 2).sum())) for v in self.values])
        self.flat = np.concatenate([*kept, np.empty(0, dtype=np.int64)])
        self.flat_values = np.concatenate([*self.values, np.empty(0, dtype=np.int64)]).astype(np.float64)
        self.owner = np.repeat(np.arange(len(kept)), [len(t) for t in kept])

    def at_most(self, greatest: np.ndarray) -> np.ndarray:
        """No score of an item is higher, by the greatest impact of each term."""
        return np.bincount(self.owner, weights=self.flat_values * greatest[self.flat], minlength=len(self.terms))


class Bucket:
    """Vectors of like length: entries by vector and by term."""

    def __init__(self, n_terms: int, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, norms: np.ndarray):
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.terms, self.impacts, self.norms = terms, impacts, norms
        self.longest = float(norms.max())
        order = np.argsort(terms, kind="stable")
        self.row, self.value = np.repeat(np.arange(len(sizes)), sizes)[order], impacts[order].astype(np.float64)
        self.term_starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.greatest = np.zeros(n_terms)
        np.maximum.at(self.greatest, terms, impacts)

    def survivors(self, terms: np.ndarray, values: np.ndarray, threshold: int) -> np.ndarray:
        """Rows that may score ``threshold`` or more."""
        most = values * self.greatest[terms]
        order = np.argsort(-most, kind="stable")
        terms, values, most = terms[order], values[order].astype(np.float64), most[order]
        rest = np.append(np.cumsum(most[::-1])[::-1], 0.0)
        rest_norm = np.sqrt(np.append(np.cumsum((values**2)[::-1])[::-1], 0.0))
        low = threshold * _SLACK
        focus = int(np.argmax(np.minimum(rest, rest_norm * self.longest) < low))
        if not focus:
            return np.empty(0, dtype=np.int64)
        spans = [slice(self.term_starts[t], self.term_starts[t + 1]) for t in terms[:focus].tolist()]
        row, value = np.concatenate([self.row[s] for s in spans]), np.concatenate([self.value[s] for s in spans])
        weight = np.repeat(values[:focus], [s.stop - s.start for s in spans])
        partial = np.bincount(row, weights=value * weight, minlength=len(self.sizes))
        seen = np.bincount(row, weights=value * value, minlength=len(self.sizes))
        unseen = np.sqrt(np.maximum(self.norms**2 - seen, 0.0)) + 1e-6 * self.norms
        return np.flatnonzero((partial > 0) & (partial + np.minimum(rest[focus], rest_norm[focus] * unseen) >= low))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Inner products of some rows with ``dense``, exactly."""
        sizes = self.sizes[rows]
        begin = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[rows] - begin, sizes)
        return np.add.reduceat(dense[self.terms[at]] * self.impacts[at], begin)


class Best:
    """The k best results of each item so far."""

    def __init__(self, thresholds: np.ndarray, k: int):
        self.k, self.least = k, np.maximum(thresholds, 1)
        self.score = [np.empty(0, dtype=np.int64) for _ in thresholds]
        self.key = list(self.score)

    def add(self, item: int, score: np.ndarray, key: np.ndarray) -> None:
        good = score >= self.least[item]
        if not good.any():
            return
        score, key = np.append(self.score[item], score[good]), np.append(self.key[item], key[good])
        order = np.lexsort((key, -score))[: self.k]
        self.score[item], self.key[item] = score[order], key[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], int(score[order[-1]]))


def search_bucket(bucket: Bucket, keys: np.ndarray, items: Items, best: Best, dense: np.ndarray) -> int:
    """Search all items in a bucket; gives the number of vectors that were scored."""
    able = (items.norms * bucket.longest >= best.least * _SLACK) & (items.at_most(bucket.greatest) >= best.least * _SLACK)
    scored = 0
    for i in np.flatnonzero(able).tolist():
        rows = bucket.survivors(items.terms[i], items.values[i], int(best.least[i]))
        if len(rows):
            dense[items.terms[i]] = items.values[i]
            best.add(i, bucket.scores(rows, dense), keys[rows])
            dense[items.terms[i]] = 0
            scored += len(rows)
    return scored


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", k: int = K, block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``(item_key, rank, key, score)``: the ``k`` best documents of each item that share a term with it.

    ``key`` holds integers; equal scores stand by ascending key, a missing key last.  A null or empty
    text has no term and counts as no document.  Rows of ``docs`` that repeat a key are documents of
    their own; rows of ``items`` alike in key and text are one item, and a null item key stays null.
    Terms no document holds add nothing.  Other columns are not read; no rows on either side give no rows.
    """
    spark, known = docs.sparkSession, F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_KEY))
    size = items.agg(F.sum(F.octet_length(item_text))).first()[0] or 0
    blocks = -(-size // block_bytes)
    parts = [
        _search_block(docs.select(known.alias("key"), F.col(text).alias("text")), part, k, bucket_rows)
        for b in range(blocks)
        for part in [_block(items, item_key, item_text, b, blocks)]
    ]
    schema = f"no int, rank int, key bigint, score bigint, item {items.schema[item_key].dataType.simpleString()}"
    out = next(iter(parts), spark.createDataFrame([], schema))
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item").alias(item_key), "rank", F.col("key").cast(docs.schema[key].dataType).alias(key), "score")


def _block(items: DataFrame, key: str, text: str, block: int, blocks: int) -> DataFrame:
    rows = items.select(F.col(key).alias("item"), F.col(text).alias("text")).where("text is not null").distinct()
    return rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)


def _search_block(docs: DataFrame, items: DataFrame, k: int, bucket_rows: int) -> DataFrame:
    spark = docs.sparkSession
    rows = items.collect()  # about block_bytes of text
    vocabulary: dict[bytes, int] = {}
    counts = [Counter(vocabulary.setdefault(t, len(vocabulary)) for t in terms_of(r["text"])) for r in rows]
    n_terms = len(vocabulary)
    shared = spark.sparkContext.broadcast(vocabulary)

    def count(frames):
        number = shared.value.get
        for frame in slices(frames, "text"):
            out = {"key": frame["key"], "n": [], "terms": [], "tf": []}
            for value in frame["text"]:
                terms = terms_of(value)
                held = Counter(map(number, terms))
                held.pop(None, None)
                out["n"].append(len(terms))
                out["terms"].append(np.fromiter(held.keys(), "<i4", len(held)).tobytes())
                out["tf"].append(np.fromiter(held.values(), "<i4", len(held)).tobytes())
            yield pd.DataFrame(out)

    counted = store(docs.mapInPandas(count, "key bigint, n bigint, terms binary, tf binary"), "search-counts")

    def tally(frames):
        """Documents that hold each term; below 0 the number of documents and of their terms."""
        held, n, length = np.zeros(n_terms, dtype=np.int64), 0, 0
        for frame in frames:
            held += np.bincount(np.frombuffer(b"".join(frame["terms"]), dtype="<i4"), minlength=n_terms)
            n, length = n + int((frame["n"] > 0).sum()), length + int(frame["n"].sum())
        at = np.flatnonzero(held)
        yield pd.DataFrame({"term": [*at.tolist(), -1, -2], "n": [*held[at].tolist(), n, length]})

    # A row for each term of the block at most.
    totals = counted.select("n", "terms").mapInPandas(tally, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    totals = {r["term"]: r["n"] for r in totals.collect()}
    documents, length = totals.get(-1, 0), totals.get(-2, 0)
    weights = np.array([weight_of(documents, totals[t]) if t in totals else 0 for t in range(n_terms)], dtype=np.int64)
    block = spark.sparkContext.broadcast(Items(counts, weights))

    def measure(frames):
        for frame in frames:
            sizes = frame["terms"].str.len().to_numpy(dtype=np.int64) // 4
            tf = np.frombuffer(b"".join(frame["tf"]), dtype="<i4").astype(np.int64)
            impacts = impacts_of(tf, np.repeat(frame["n"].to_numpy(), sizes), documents, length).astype("<i4")
            starts = np.cumsum(sizes) - sizes
            norms = np.sqrt(np.add.reduceat(impacts.astype(np.float64) ** 2, starts)) if len(starts) else np.empty(0)
            parts = [impacts[a : a + s].tobytes() for a, s in zip(starts.tolist(), sizes.tolist())]
            yield pd.DataFrame({"key": frame["key"], "terms": frame["terms"], "impacts": parts, "norm": norms, "tie": frame["tie"]})

    # Copies have the same length: a number of the row spreads them.
    some = counted.where(F.length("terms") > 0).withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    vectors = some.mapInPandas(measure, "key bigint, terms binary, impacts binary, norm double, tie bigint")
    vectors = store(store(vectors, "search-vectors").repartitionByRange(F.desc("norm"), "tie").sortWithinPartitions(F.desc("norm")), "search-sorted")

    def scan(thresholds):
        def run(frames):
            items_, best, dense = block.value, Best(thresholds, k), np.zeros(n_terms, dtype=np.int64)
            for frame in frames:
                frame = frame.sort_values("norm", ascending=False, kind="stable")
                for a in range(0, len(frame), bucket_rows):
                    part = frame.iloc[a : a + bucket_rows]
                    sizes = part["terms"].str.len().to_numpy(dtype=np.int64) // 4
                    terms = np.frombuffer(b"".join(part["terms"]), dtype="<i4").astype(np.int64)
                    impacts = np.frombuffer(b"".join(part["impacts"]), dtype="<i4").astype(np.int64)
                    bucket = Bucket(n_terms, sizes, terms, impacts, part["norm"].to_numpy())
                    search_bucket(bucket, part["key"].to_numpy(), items_, best, dense)
            found = [len(s) for s in best.score]
            yield pd.DataFrame(
                {
                    "no": np.repeat(np.arange(len(found)), found),
                    "key": np.concatenate([*best.key, np.empty(0, dtype=np.int64)]),
                    "score": np.concatenate([*best.score, np.empty(0, dtype=np.int64)]),
                }
            )

        return run

    def best_of(found):
        order = Window.partitionBy("no").orderBy(F.desc("score"), "key")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    columns, schema = ["key", "terms", "impacts", "norm"], "no int, key bigint, score bigint"
    cut = vectors.agg(F.percentile_approx("norm", 1 - FIRST_SHARE)).first()[0] or 0.0
    none = np.zeros(len(rows), dtype=np.int64)
    first = store(best_of(vectors.where(F.col("norm") >= cut).select(*columns).mapInPandas(scan(none), schema)), "search-first")
    thresholds = none.copy()
    for r in first.where(F.col("rank") == k).collect():  # a row for each item at most
        thresholds[r["no"]] = r["score"]
    norms = block.value.norms
    least = float(np.min(np.maximum(thresholds, 1)[norms > 0] / norms[norms > 0], initial=np.inf)) * _SLACK
    later = vectors.where((F.col("norm") < cut) & (F.col("norm") >= least)).select(*columns)
    found = best_of(first.drop("rank").unionByName(later.mapInPandas(scan(thresholds), schema)))
    # One row for each item of the block.
    type_ = items.schema["item"].dataType.simpleString()
    named = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"no int, item {type_}")
    out = found.join(F.broadcast(named), "no")
    return out.withColumn("key", F.nullif(F.col("key"), F.lit(_NULL_KEY))).select("no", F.col("rank").cast("int"), "key", "score", "item")
