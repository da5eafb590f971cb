"""Reproducible splits and folds.

Each row has a ticket, the md5 of its key and a seed.  A split is a comparison of the ticket
with cut tickets at exact ranks, so the rows themselves are never shuffled or sorted: counts
per ticket prefix locate the prefix that holds a wanted rank, and only that prefix is ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.sizing import TASK_ROWS, join_null_safe, lookup_side


def ticket(key: list[str] | str, seed: int) -> Column:
    """The row's place in a pseudo-random order that does not depend on partitioning."""
    parts = [key] if isinstance(key, str) else list(key)
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in parts], F.lit(str(seed)))
    return F.md5(text.cast("binary"))


def _prefix_digits(rows: int, task_rows: int) -> int:
    """Hex digits that bring a prefix group under ``task_rows`` rows."""
    return 0 if rows <= task_rows else math.ceil(math.log(rows / task_rows, 16)) + 1


def _cuts(df: DataFrame, strata: list[str], ranks, task_rows: int) -> DataFrame:
    """``(*strata, cuts)``: tickets at the 1-based ranks ``ranks(n)`` of each stratum, ascending."""
    digits = _prefix_digits(df.count(), task_rows)
    rows = df.select(*strata, "__ticket", F.substring("__ticket", 1, digits).alias("__prefix"))
    whole = Window.partitionBy(*(strata or [F.lit(0)]))
    before = whole.orderBy("__prefix").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        rows.groupBy(*strata, "__prefix")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("below", F.coalesce(F.sum("cnt").over(before), F.lit(0)))
        .withColumn("n", F.sum("cnt").over(whole))
    )
    wanted = (
        counts.withColumn("rank", F.explode(ranks(F.col("n"))))
        .where("rank > below and rank <= below + cnt")
        .select(*strata, "__prefix", (F.col("rank") - F.col("below")).alias("__rank"))
    )
    inside = Window.partitionBy(*strata, "__prefix").orderBy("__ticket")
    keys = [*strata, "__prefix"]
    held = join_null_safe(rows, lookup_side(wanted.select(*keys).distinct()), keys, "inner")
    ranked = held.withColumn("__rank", F.row_number().over(inside).cast("bigint"))
    found = join_null_safe(ranked, lookup_side(wanted), [*keys, "__rank"], "inner")
    return found.groupBy(*strata).agg(F.sort_array(F.collect_set("__ticket")).alias("__cuts"))


def _with_cuts(df, key, seed, stratify, ranks, task_rows):
    base = df.withColumn("__ticket", ticket(key, seed))
    if not stratify:
        return base.withColumn("__cuts", _cuts(base, [], ranks, task_rows).scalar())
    joined = join_null_safe(base, lookup_side(_cuts(base, [stratify], ranks, task_rows)), [stratify])
    return joined.withColumn("__cuts", F.coalesce("__cuts", F.array().cast("array<string>")))


def split(
    df: DataFrame,
    key: list[str] | str,
    test_size: float,
    seed: int,
    stratify: str | None = None,
    name: str = "part",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``part``: ``test`` for an exact share of the rows, else ``train``.

    Unstratified the test part has ``ceil(share * n)`` rows; stratified each class gives
    ``floor(share * n + 0.5)`` of its rows.  ``key`` must identify a row.
    """
    def ranks(n):
        size = F.floor(n * F.lit(test_size) + 0.5) if stratify else F.ceil(n * F.lit(test_size))
        return F.array(size.cast("bigint"))

    joined = _with_cuts(df, key, seed, stratify, ranks, task_rows)
    chosen = F.exists("__cuts", lambda c: F.col("__ticket") <= c)
    return joined.withColumn(name, F.when(chosen, "test").otherwise("train")).select(*df.columns, name)


def folds(
    df: DataFrame,
    key: list[str] | str,
    k: int,
    seed: int,
    stratify: str | None = None,
    name: str = "fold",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``fold`` 0 .. k-1, of sizes that differ by at most one (in each class when stratified).

    The first ``n mod k`` folds hold the extra rows.
    """
    def ranks(n):
        cuts = [F.lit(i) * F.floor(n / k) + F.least(F.lit(i), n % k) for i in range(1, k)]
        return F.array_distinct(F.array(*[c.cast("bigint") for c in cuts]))

    joined = _with_cuts(df, key, seed, stratify, ranks, task_rows)
    at = F.size(F.filter("__cuts", lambda c: c < F.col("__ticket")))
    return joined.withColumn(name, at.cast("int")).select(*df.columns, name)
