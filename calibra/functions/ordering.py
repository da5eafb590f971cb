"""Ordered work without a one-task window.

Rows are cut into contiguous range segments of the order columns.  Inside a segment an
ordinary window does the work; between segments only one summary row per segment travels.
A hot group (or no group at all) is therefore spread over many tasks.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .sizing import TASK_ROWS, join_null_safe

MAX_SEGMENTS = 4096
_SAMPLE_PER_SEGMENT = 40


def range_bounds(df: DataFrame, cols: list[str], segments: int, total: int) -> list:
    """Split points of ``cols`` from a seeded sample of a table of ``total`` rows.

    The sample has about forty rows per segment, the result at most ``segments - 1`` rows.
    """
    fraction = min(1.0, _SAMPLE_PER_SEGMENT * segments / max(total, 1))
    sample = df.select(*cols).sample(False, fraction, 42).orderBy(*cols).collect()
    picked, last = [], None
    for i in range(1, segments):
        at = i * len(sample) // segments
        if at < len(sample) and sample[at] != last:
            last = sample[at]
            picked.append(last)
    return picked


def with_bucket(df: DataFrame, cols: list[str], bounds: list, name: str) -> DataFrame:
    """Add the number of ``bounds`` not above the row, as a pure function of ``cols``.

    One numeric or time column is enough when the bounds differ in it, and is searched in
    compiled code.  Only when one of its values is hot enough to fill several segments (or it is
    text) do the further columns take part.
    """
    if not bounds:
        return df.withColumn(name, F.lit(0))
    kind = df.schema[cols[0]].dataType
    if isinstance(kind, (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType)):
        number = _as_double(F.col(cols[0]), kind)
        schema = T.StructType([T.StructField("v", kind)])
        local = df.sparkSession.createDataFrame([(b[cols[0]],) for b in bounds], schema)
        splits = [r[0] for r in local.select(_as_double(F.col("v"), kind)).collect()]
        if None not in splits and len(set(splits)) == len(splits):
            # Missing values sort first, into bucket 0; the other buckets count from 0 as well.
            near = df.withColumn("__num", F.coalesce(number, F.lit(float("-inf"))))
            bucketizer = Bucketizer(
                splits=[float("-inf"), *sorted(splits), float("inf")], inputCol="__num", outputCol="__bucket", handleInvalid="keep"
            )
            return bucketizer.transform(near).withColumn(name, F.col("__bucket").cast("int")).drop("__num", "__bucket")
    return df.withColumn(name, _lexical_bucket(df, cols, bounds))


def _as_double(col: Column, kind) -> Column:
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    return col.cast("timestamp").cast("double")


def _lexical_bucket(df: DataFrame, cols: list[str], bounds: list) -> Column:
    """Binary search over a literal array of key structs."""
    fields = [df.schema[c] for c in cols]

    def literal(row):
        return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in fields])

    table = F.array(*[literal(b) for b in bounds])
    key = F.struct(*cols)
    steps = [2**i for i in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at),
    )


def segmented(df: DataFrame, order: list[str], task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Add ``__seg``, the range segment of each row; None when the whole table fits one task."""
    total = df.count()
    segments = min(MAX_SEGMENTS, -(-total // task_rows))
    if segments <= 1:
        return None
    return with_bucket(df, order, range_bounds(df, order, segments, total), "__seg")


def _by(by: list[str]):
    """Window over the groups; without groups the caller has checked that the rows fit one task."""
    return Window.partitionBy(*(by or [F.lit(0)]))


def with_position(
    df: DataFrame,
    order: list[str],
    by: list[str] = (),
    name: str = "position",
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Exact 0-based position of each row in ``order``, within ``by`` when given."""
    by = list(by)
    base = segmented(df, order, task_rows)
    if base is None:
        return df.withColumn(name, (F.row_number().over(_by(by).orderBy(*order)) - 1).cast("bigint"))
    inside = Window.partitionBy(*by, "__seg").orderBy(*order)
    before = _by(by).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    sizes = base.groupBy(*by, "__seg").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select(*by, "__seg", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = base.withColumn("__rn", F.row_number().over(inside) - 1)
    return (
        join_null_safe(ranked, offsets, [*by, "__seg"])
        .withColumn(name, (F.col("__rn") + F.col("__before")).cast("bigint"))
        .drop("__rn", "__before", "__seg")
    )


def with_running_total(
    df: DataFrame,
    totals: dict[str, str],
    order: list[str],
    by: list[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Sum of all earlier rows (the row itself excluded) for each ``{new name: column}``."""
    by = list(by)
    base = segmented(df, order, task_rows)
    if base is None:
        earlier = _by(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumns({n: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for n, c in totals.items()})
    inside = Window.partitionBy(*by, "__seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = _by(by).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    names = list(totals)
    sums = base.groupBy(*by, "__seg").agg(*[F.sum(c).alias(f"__t{i}") for i, c in enumerate(totals.values())])
    offsets = sums.select(
        *by, "__seg", *[F.coalesce(F.sum(f"__t{i}").over(before), F.lit(0)).alias(f"__b{i}") for i in range(len(names))]
    )
    inner = base.withColumns({n: F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in totals.items()})
    joined = join_null_safe(inner, offsets, [*by, "__seg"])
    joined = joined.withColumns({n: F.col(n) + F.col(f"__b{i}") for i, n in enumerate(names)})
    return joined.drop("__seg", *[f"__b{i}" for i in range(len(names))])


def with_gap_edges(
    df: DataFrame,
    col: str,
    order: list[str],
    by: list[str] = (),
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """Add ``__pos``, ``__prev`` and ``__next``.

    ``__prev`` and ``__next`` are ``struct(pos, value)`` of the nearest non-missing value at or
    before, and at or after, the row.
    """
    by = list(by)
    base = segmented(df, order, task_rows)
    if base is None:
        group = _by(by)
        placed = df.withColumn("__pos", (F.row_number().over(group.orderBy(*order)) - 1).cast("bigint"))
        return _nearest(placed, col, group, order)
    group = Window.partitionBy(*by, "__seg")
    ranked = base.withColumn("__rn", (F.row_number().over(group.orderBy(*order)) - 1).cast("bigint"))
    seen = F.when(F.col(col).isNotNull(), F.struct(F.col("__rn").alias("pos"), F.col(col).alias("value")))

    per_segment = ranked.groupBy(*by, "__seg").agg(
        F.count(F.lit(1)).alias("__n"),
        F.max_by(seen, F.when(F.col(col).isNotNull(), F.col("__rn"))).alias("__tail"),
        F.min_by(seen, F.when(F.col(col).isNotNull(), F.col("__rn"))).alias("__head"),
    )
    # A growing frame costs one step per row only when it grows from the start, hence the
    # reversed orders instead of frames that reach to the end.
    chain = _by(by)
    earlier = chain.orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    later = chain.orderBy(F.desc("__seg")).rowsBetween(Window.unboundedPreceding, -1)

    def shifted(edge):
        return F.when(
            F.col(edge).isNotNull(),
            F.struct((F.col(edge)["pos"] + F.col("__before")).alias("pos"), F.col(edge)["value"].alias("value")),
        )

    carried = (
        per_segment.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
        .withColumn("__tail", shifted("__tail"))
        .withColumn("__head", shifted("__head"))
        .select(
            *by,
            "__seg",
            "__before",
            F.last("__tail", ignorenulls=True).over(earlier).alias("__from_left"),
            F.last("__head", ignorenulls=True).over(later).alias("__from_right"),
        )
    )
    joined = join_null_safe(ranked, carried, [*by, "__seg"]).withColumn("__pos", F.col("__rn") + F.col("__before"))
    return (
        _nearest(joined, col, group, order)
        .withColumn("__prev", F.coalesce("__prev", "__from_left"))
        .withColumn("__next", F.coalesce("__next", "__from_right"))
        .drop("__rn", "__before", "__seg", "__from_left", "__from_right")
    )


def _nearest(df: DataFrame, col: str, group, order: list[str]) -> DataFrame:
    """``__prev`` and ``__next`` inside one window group."""
    here = F.when(F.col(col).isNotNull(), F.struct(F.col("__pos").alias("pos"), F.col(col).alias("value")))
    upto = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    onward = group.orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumn("__here", here)
        .withColumn("__prev", F.last("__here", ignorenulls=True).over(upto))
        .withColumn("__next", F.last("__here", ignorenulls=True).over(onward))
        .drop("__here")
    )
