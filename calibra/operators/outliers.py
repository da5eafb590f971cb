"""Interquartile-range fences and quantile trims."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.quantiles import quantiles
from ..functions.sizing import TASK_ROWS, bounded_rows

# Fence width in interquartile ranges, and the smallest column that is judged.
FENCE = 1.5
MIN_VALUES = 4


def iqr_bounds(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """``(column, q1, q3, iqr, low, high)``; columns with fewer than four values are left out."""
    q1, q3 = F.col("q")[0], F.col("q")[1]
    iqr = q3 - q1
    return (
        quantiles(df, cols, [0.25, 0.75], task_rows=task_rows)
        .where(F.col("n") >= MIN_VALUES)
        .select(
            "column",
            q1.alias("q1"),
            q3.alias("q3"),
            iqr.alias("iqr"),
            (q1 - FENCE * iqr).alias("low"),
            (q3 + FENCE * iqr).alias("high"),
        )
    )


def _fences(df: DataFrame, cols: list[str], task_rows: int) -> dict[str, tuple[float, float]]:
    """Fences as plain numbers: one row per listed column."""
    rows = bounded_rows(iqr_bounds(df, cols, task_rows), len(cols), "fences")
    return {r["column"]: (r["low"], r["high"]) for r in rows}


def _outside(col: str, fence: tuple[float, float]) -> Column:
    """True outside the fences; a missing value is no outlier."""
    return F.coalesce((F.col(col) < fence[0]) | (F.col(col) > fence[1]), F.lit(False))


def iqr_report(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """``(column, outliers)`` per column and one row ``total``, in one pass after the fences."""
    fences = _fences(df, cols, task_rows)
    if not fences:
        return df.sparkSession.createDataFrame([("total", 0)], "column string, outliers bigint")
    names = [c for c in cols if c in fences]
    wide = df.agg(*[F.count_if(_outside(c, fences[c])).alias(f"o{i}") for i, c in enumerate(names)])
    counts = [F.col(f"o{i}") for i in range(len(names))]
    cells = [F.struct(F.lit(c).alias("column"), n.alias("outliers")) for c, n in zip(names, counts)]
    cells.append(F.struct(F.lit("total").alias("column"), reduce(lambda a, b: a + b, counts).alias("outliers")))
    return wide.select(F.inline(F.array(*cells)))


def iqr_rows(df: DataFrame, col: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows whose value lies outside the fences of ``col``."""
    fences = _fences(df, [col], task_rows)
    return df.where(_outside(col, fences[col])) if col in fences else df.limit(0)


def iqr_drop(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Remove the rows that are outliers in any of the columns."""
    fences = _fences(df, cols, task_rows)
    for c, fence in fences.items():
        df = df.where(~_outside(c, fence))
    return df


def trim_quantile(df: DataFrame, col: str, q: float, task_rows: int = TASK_ROWS) -> DataFrame:
    """Keep the rows at or below the ``q`` quantile; a missing value is not kept."""
    limit = quantiles(df, [col], [q], task_rows=task_rows).select(F.col("q")[0]).scalar()
    return df.where(F.col(col) <= limit)
