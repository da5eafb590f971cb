"""Exact, linearly interpolated quantiles.

Up to ``TASK_ROWS`` values one aggregate with ``percentile`` answers for all columns.  Its state
holds every distinct value of a group in one task, so above that size the wanted ranks are
bracketed instead: approximate split points, counts per bracket, and exact ranking only inside
the brackets that hold a wanted rank.  No full sort and no unbounded state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .ordering import with_bucket
from .sizing import TASK_ROWS, join_null_safe, lookup_side

_FEWEST, _MOST = 100, 10_000


def quantiles(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    by: list[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """One row per group and column: ``(*by, column, n, q)``, ``q`` in the order of ``probs``.

    NaN counts as missing.  Where all values of a group are missing ``q`` is, and the row is there.
    """
    by, probs = list(by), [float(p) for p in probs]
    missing = F.lit(None).cast("double")
    others = [F.col(c) for c in by if c not in cols]
    # A column that is also a key keeps its own type as key.
    df = df.select(*others, *[F.nanvl(F.col(c).cast("double"), missing).alias(c) for c in cols if c not in by], *[c for c in cols if c in by])
    total = df.count()
    if total * len(cols) <= task_rows:
        return _in_one_aggregate(df, cols, probs, by)
    return _by_brackets(df, cols, probs, by, min(_MOST, max(_FEWEST, total // TASK_ROWS)))


def quantile_row(df: DataFrame, cols: list[str], probs: list[float], task_rows: int = TASK_ROWS) -> DataFrame:
    """Quantiles of the whole table as one row: a struct field ``<col>`` of arrays per column."""
    long = quantiles(df, cols, probs, task_rows=task_rows)
    return long.groupBy().agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in cols]).alias("q")
    )


def _in_one_aggregate(df, cols, probs, by):
    wanted = F.array(*[F.lit(p) for p in probs])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"__n{i}"), F.percentile(x, wanted).alias(f"__q{i}")]
    wide = df.groupBy(*by).agg(*aggs)
    cells = [
        F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("n"), F.col(f"__q{i}").alias("q"))
        for i, c in enumerate(cols)
    ]
    return wide.select(*by, F.inline(F.array(*cells)))


def _by_brackets(df, cols, probs, by, brackets=_FEWEST):
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"__n{i}").alias("n")) for i, c in enumerate(cols)]
    listed = df.groupBy(*by).agg(*[F.count(c).alias(f"__n{i}") for i, c in enumerate(cols)])
    listed = listed.select(*by, F.inline(F.array(*cells)))
    df = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols])
    grid = [i / brackets for i in range(1, brackets)]
    # The split points need not be exact, only the counts between them are.
    row = df.agg(*[F.percentile_approx(c, grid, 5 * brackets).alias(c) for c in cols]).first()
    cells = []
    for i, c in enumerate(cols):
        df = with_bucket(df, [c], [{c: v} for v in sorted(set(row[c] or []))], f"__seg{i}")
        cells.append(F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"__seg{i}").alias("seg")))
    long = df.select(*by, F.inline(F.array(*cells))).where("value is not null")
    keys = [*by, "column"]

    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        long.groupBy(*keys, "seg")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("below", F.coalesce(F.sum("cnt").over(upto), F.lit(0)))
        .withColumn("n", F.sum("cnt").over(whole))
    )
    ranks = F.array_distinct(
        F.flatten(
            F.array(
                *[
                    F.array(f(F.lit(p) * (F.col("n") - 1)).cast("bigint"))
                    for p in probs
                    for f in (F.floor, F.ceil)
                ]
            )
        )
    )
    wanted = counts.withColumn(
        "ranks",
        F.filter(ranks, lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("cnt"))),
    ).where(F.size("ranks") > 0)
    wanted = lookup_side(wanted.select(*keys, "seg", "below", "n", "ranks"))

    inner = join_null_safe(long, wanted, [*keys, "seg"], "inner")
    values = inner.groupBy(*keys, "seg", "below", "n", "ranks", "value").agg(F.count(F.lit(1)).alias("cnt"))
    running = Window.partitionBy(*keys, "seg").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        values.withColumn("start", F.col("below") + F.coalesce(F.sum("cnt").over(running), F.lit(0)))
        .withColumn("rank", F.explode("ranks"))
        .where("rank >= start and rank < start + cnt")
    )
    at = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def interpolated(p):
        pos = F.lit(p) * (F.col("n") - 1)
        low = F.element_at("at", F.floor(pos).cast("bigint"))
        high = F.element_at("at", F.ceil(pos).cast("bigint"))
        return low + (pos - F.floor(pos)) * (high - low)

    # Groups without any value have no bracket, but a row all the same.
    whole = join_null_safe(listed, at, keys)
    return whole.select(*keys, "n", F.when(F.col("at").isNotNull(), F.array(*[interpolated(p) for p in probs])).alias("q"))


