"""Filling missing values: constants, statistics, group medians and ordered fills."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import with_gap_edges
from ..functions.quantiles import quantile_row, quantiles
from ..functions.sizing import TASK_ROWS, join_null_safe, lookup_side
from .describe import modes


def fill_const(df: DataFrame, values) -> DataFrame:
    """Fill with one constant, or with a constant per column."""
    return df.fillna(values)


def fill_stat(df: DataFrame, cols: list[str], stat: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Fill with the column's global mean, median or most frequent value."""
    if stat == "mean":
        row = df.agg(F.struct(*[F.avg(c).alias(c) for c in cols]).alias("s"))
        return _coalesced(df, cols, {c: row.scalar()[c] for c in cols})
    if stat == "median":
        row = quantile_row(df, cols, [0.5], task_rows)
        return _coalesced(df, cols, {c: row.scalar()[c][0] for c in cols})
    if stat == "mode":
        return _coalesced(df, cols, {c: modes(df, [c]).select("top").scalar() for c in cols})
    raise ValueError(f"unknown statistic {stat!r}")


def _coalesced(df, cols, replacement):
    return df.withColumns({c: F.coalesce(F.col(c), replacement[c].cast(df.schema[c].dataType)) for c in cols})


def fill_group(
    df: DataFrame,
    by: list[str],
    cols: list[str],
    fallback_after: bool = True,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Fill with the median of the row's group, then with the global median.

    ``fallback_after`` takes the global median from the column after the group fill; otherwise
    from the column as it came.  The two differ only when a whole group is missing.
    """
    medians = quantiles(df, cols, [0.5], by, task_rows)
    wide = medians.groupBy(*by).agg(*[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"__m_{c}") for c in cols])
    side = lookup_side(wide)
    joined = join_null_safe(df, side, by)
    present = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    filled = joined.withColumns({c: F.coalesce(present[c], F.col(f"__m_{c}")) for c in cols})
    filled = filled.drop(*[f"__m_{c}" for c in cols])
    if side.where(F.greatest(*[F.col(f"__m_{c}").isNull() for c in cols], F.lit(False))).isEmpty():
        # Every group has a median, so nothing is left for the global one.
        return filled
    row = quantile_row(filled if fallback_after else df, cols, [0.5], task_rows)
    return _coalesced(filled, cols, {c: row.scalar()[c][0] for c in cols})


def ffill(df: DataFrame, col: str, order: list[str], by: list[str] = (), task_rows: int = TASK_ROWS) -> DataFrame:
    """Forward fill in an explicit order, over the whole table or within ``by``."""
    edges = with_gap_edges(df, col, order, by, task_rows)
    return _replaced(df, edges, col, F.coalesce(F.col(col), F.col("__prev")["value"]))


def bfill(df: DataFrame, col: str, order: list[str], by: list[str] = (), task_rows: int = TASK_ROWS) -> DataFrame:
    """Backward fill in an explicit order."""
    edges = with_gap_edges(df, col, order, by, task_rows)
    return _replaced(df, edges, col, F.coalesce(F.col(col), F.col("__next")["value"]))


def interpolate(df: DataFrame, col: str, order: list[str], by: list[str] = (), task_rows: int = TASK_ROWS) -> DataFrame:
    """Linear interpolation by row position.

    Leading gaps stay missing; trailing gaps take the last value.
    """
    edges = with_gap_edges(df, col, order, by, task_rows)
    left, right = F.col("__prev"), F.col("__next")
    step = (F.col("__pos") - left["pos"]) / (right["pos"] - left["pos"])
    inside = left["value"] + (right["value"] - left["value"]) * step
    value = (
        F.when(F.col(col).isNotNull(), F.col(col))
        .when(left.isNotNull() & right.isNotNull(), inside)
        .otherwise(left["value"])
    )
    return _replaced(df, edges, col, value)


def _replaced(df, edges, col, value):
    return edges.withColumn(col, value).select(*df.columns)
