"""Mixing sources to target weights by systematic sampling.

Every source gets a target share of all words, and every document a number of expected copies.
Within a source the documents stand in a fixed order, by size class, hash bucket and id.  Running
sums of expected copies plus one random offset a source are cut at the integers: a document is taken
once per integer its interval crosses.

Documents expect target over size of their source, save the large ones.  From the largest size class
down, a class whose documents hold more than ``1 / LARGE`` of the target each expects a whole number
of copies in all, and what it takes too much or too little is left to the smaller ones.  So a long
document does not throw its source off.  Of a few random offsets the one that comes nearest is used,
as estimated from the counts alone (a bucket with one document enters exactly).

The running position needs no pass over a whole source: documents are counted per (source, class,
bucket), the counts are summed up, and the position inside a bucket is a window over that bucket.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.sizing import bounded_rows
from .shared import fresh, store

CYCLE, MOST = (1, 2, 3), 3
BUCKETS, CLASSES_PER_DOUBLING, MAX_SOURCES, LARGE = 256, 16, 100_000, 200
SEED, OFFSETS = 11, 32


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[Fraction]:
    """Shares of ``sum(sizes)`` by weight, none above ``most`` times its own size; the excess is shared again."""
    out, left, open_ = [Fraction(0)] * len(sizes), Fraction(sum(sizes)), set(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] > most * sizes[i] * total}
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = Fraction(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ -= over
    return out


def expected_copies(n: np.ndarray, size: np.ndarray, target: float, most: int = MOST, large: int = LARGE) -> np.ndarray:
    """Expected copies of a document of each size class, given documents and words, smallest class first."""
    out, left, rest = np.zeros(len(n)), float(target), float(size.sum())
    for k in range(len(n) - 1, -1, -1):
        mean = size[k] / n[k]
        if mean * large <= target:
            out[: k + 1] = min(left / rest, most) if rest > 0 else 0.0
            break
        share = min(n[k] * left / rest, most * n[k])
        rest -= size[k]

        def off(copies):
            after = left - copies * mean
            return max(-after, after - most * rest, 0.0), abs(copies - share)

        copies = min(np.floor(share), np.ceil(share), key=off)
        out[k] = copies / n[k]
        left = max(left - copies * mean, 0.0)
    return out


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    cycle: tuple[int, ...] = CYCLE,
    most: int = MOST,
    seed: int = SEED,
    offsets: int = OFFSETS,
    max_sources: int = MAX_SOURCES,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns size, source_size, target, copies, and their names in the result.

    The size of a document is its number of words (null: 0).  Sources in the order of their code
    points, the missing one last, weigh ``cycle``, repeating.  No document is taken more than
    ``most`` times.  The result does not depend on the partitions: rows that repeat id and size are
    alike.  A missing key sorts first.  More than ``max_sources`` sources fail loudly; no rows give
    no rows.  Columns are named apart from those that ``docs`` has.
    """
    names = dict(zip(("size", "source_size", "target", "copies"), fresh(docs, "size", "source_size", "target", "copies")))
    size = names["size"]
    none, src, cls, bucket, ratio, start, n, offset = fresh(docs, "__none", "__src", "__cls", "__bucket", "__ratio", "__start", "__n", "__offset")
    group, before_class = [none, src, cls, bucket], fresh(docs, "__before")[0]
    sized = docs.withColumn(size, F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint"))
    sized = sized.withColumns(
        {
            none: F.col(source).isNull(),
            src: F.coalesce(F.col(source).cast("string"), F.lit("")),
            cls: F.floor(F.log2(F.col(size) + 1) * CLASSES_PER_DOUBLING).cast("int"),
            bucket: F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(BUCKETS)).cast("int"),
        }
    )
    counts = store(sized.groupBy(*group).agg(F.count(F.lit(1)).alias(n), F.sum(size).alias(size)), "mix-counts")
    by_source = bounded_rows(counts.groupBy(none, src).agg(F.sum(size).alias(size)), max_sources, "sources")
    # UTF-8 sorts as code points do.
    by_source.sort(key=lambda r: (r[none], r[src].encode("utf-8", "surrogatepass")))
    sizes = [r[size] for r in by_source]
    shares = targets(sizes, [cycle[i % len(cycle)] for i in range(len(sizes))], most)
    rows = [(r[none], r[src], s, float(t)) for r, s, t in zip(by_source, sizes, shares)]
    # At most max_sources rows.
    schema = f"`{none}` boolean, `{src}` string, `{names['source_size']}` bigint, `{names['target']}` double"
    table = F.broadcast(docs.sparkSession.createDataFrame(rows, schema))

    def expect(classes: pd.DataFrame) -> pd.DataFrame:
        classes = classes.sort_values(cls)
        n_, each = classes[n].to_numpy(), expected_copies(classes[n].to_numpy(), classes[size].to_numpy(), classes[names["target"]].iloc[0], most)
        copies = np.cumsum(n_ * each)
        return classes[[none, src, cls]].assign(**{ratio: each, before_class: copies - n_ * each})

    # A few hundred size classes a source.
    classes = counts.groupBy(none, src, cls).agg(F.sum(n).alias(n), F.sum(size).alias(size)).join(table, [none, src])
    classes = classes.groupBy(none, src).applyInPandas(
        expect, f"`{none}` boolean, `{src}` string, `{cls}` int, `{ratio}` double, `{before_class}` double"
    )
    before = Window.partitionBy(none, src, cls).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(start, F.coalesce(F.sum(n).over(before), F.lit(0))).join(table, [none, src])
    counts = store(counts.join(classes, [none, src, cls]), "mix-starts")

    def copies_before(i):
        return F.col(before_class) + i * F.col(ratio)

    def draw(j):
        # Halves keep whole numbers of expected copies off the cuts.
        return (F.pmod(F.xxhash64(src, none, F.lit(seed), j), F.lit(1 << 20)) + F.lit(0.5)) / float(1 << 20)

    def estimate(j):
        end = copies_before(F.col(start) + F.col(n))
        copies = F.floor(draw(F.lit(j)) + end) - F.floor(draw(F.lit(j)) + copies_before(F.col(start)))
        return F.abs(F.sum(copies * F.col(size) / F.col(n)) - F.max(names["target"]))

    tried = F.array(*[F.struct(estimate(j).alias("off"), F.lit(j).alias("j")) for j in range(offsets)])
    # At most max_sources rows.
    chosen = counts.groupBy(none, src).agg(F.array_min(tried)["j"].alias(offset))
    chosen = chosen.withColumn(offset, draw(F.col(offset)))
    starts = counts.drop(n, size).join(F.broadcast(store(chosen, "offsets")), [none, src])
    at = F.col(start) + F.row_number().over(Window.partitionBy(*group).orderBy(key, size))

    def crossed(i):
        return F.floor(F.col(offset) + copies_before(i))

    placed = sized.join(starts, group).withColumn(start, at)
    placed = placed.withColumn(
        names["copies"], F.least(crossed(F.col(start)) - crossed(F.col(start) - 1), F.lit(most)).cast("int")
    )
    return placed.drop(*group, start, ratio, before_class, offset), names


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    out, names = mix(docs, **options)
    return out.where(F.col(names["copies"]) > 0).withColumn(
        names["copies"], F.explode(F.array_repeat(F.lit(1), F.col(names["copies"])))
    ).select(*docs.columns)
