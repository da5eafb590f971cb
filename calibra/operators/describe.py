"""Descriptive statistics.  Every report fuses its columns into as few passes as possible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.quantiles import quantiles
from ..functions.sizing import TASK_ROWS, bounded_rows, join_null_safe, lookup_side
from .columns import categorical_cols, numeric_cols


def _long(wide: DataFrame, cols: list[str], fields: list[str], key: str = "column") -> DataFrame:
    """One row per column from a one-row aggregate whose columns are ``<field>_<i>``."""
    cells = [
        F.struct(F.lit(c).alias(key), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*cells)))


def shape(df: DataFrame) -> DataFrame:
    width = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(width).cast("bigint").alias("columns"), (F.col("rows") * width).alias("cells")
    )


def schema_report(df: DataFrame) -> DataFrame:
    """``(column, type, example)``; the example is the smallest non-missing value."""
    cols = df.columns
    wide = df.agg(*[F.min(c).cast("string").alias(f"example_{i}") for i, c in enumerate(cols)])
    cells = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f"example_{i}").alias("example"))
        for i, f in enumerate(df.schema)
    ]
    return wide.select(F.inline(F.array(*cells)))


def moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, count, mean, std, variance, min, max)`` with sample deviation, in one pass."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"std_{i}"),
            F.var_samp(x).alias(f"variance_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    return _long(df.agg(*aggs), cols, ["count", "mean", "std", "variance", "min", "max"])


def describe(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column; no columns give no rows."""
    if not cols:
        measures = ", ".join(f"{m} double" for m in ("mean", "std", "min", "q25", "q50", "q75", "max"))
        return df.sparkSession.createDataFrame([], f"column string, count bigint, {measures}")
    quarts = quantiles(df, cols, [0.25, 0.5, 0.75], task_rows=task_rows).select(
        "column", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75")
    )
    return (
        moments(df, cols)
        .join(quarts, "column", "left")
        .select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
    )


def value_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, whole, num, txt, n)``: the frequency of every non-missing value.

    Whole numbers are compared as such (``whole``), other numbers as double (``num``, NaN is
    missing), all others as text (``txt``).
    """
    cells = []
    for c in cols:
        kind, none = df.schema[c].dataType, F.lit(None)
        integral, numeric = isinstance(kind, T.IntegralType), isinstance(kind, T.NumericType)
        whole = F.col(c).cast("bigint") if integral else none.cast("bigint")
        num = F.nanvl(F.col(c).cast("double"), none.cast("double")) if numeric and not integral else none.cast("double")
        txt = none.cast("string") if numeric else F.col(c).cast("string")
        cells.append(F.struct(F.lit(c).alias("column"), whole.alias("whole"), num.alias("num"), txt.alias("txt")))
    return (
        df.select(F.inline(F.array(*cells)))
        .where("whole is not null or num is not null or txt is not null")
        .groupBy("column", "whole", "num", "txt")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, top, freq, unique)``: the most frequent value, ties to the smallest.

    Values are counted in a shuffled aggregate, so no task holds all distinct values.
    ``top`` is a bigint when all listed columns hold whole numbers, a double when all are numeric,
    otherwise text.
    """
    best = (
        value_table(df, cols)
        .groupBy("column")
        .agg(F.min(F.struct((-F.col("n")).alias("n"), "whole", "num", "txt")).alias("b"), F.count(F.lit(1)).alias("unique"))
    )
    whole, num = F.col("b")["whole"], F.col("b")["num"]
    if all(isinstance(df.schema[c].dataType, T.IntegralType) for c in cols):
        top = whole
    elif set(cols) <= set(numeric_cols(df)):
        top = F.coalesce(num, whole.cast("double"))
    else:
        top = F.coalesce(F.col("b")["txt"], num.cast("string"), whole.cast("string"))
    return best.select("column", top.alias("top"), (-F.col("b")["n"]).alias("freq"), "unique")


def describe_all(df: DataFrame, cols: list[str] | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Numeric description joined with unique, top and freq for text columns."""
    cols = cols or df.columns
    num = [c for c in cols if c in set(numeric_cols(df))]
    txt = [c for c in cols if c not in set(num)]
    numbers = describe(df, num, task_rows)
    empty = F.lit(None)
    numbers = numbers.withColumns(
        {"unique": empty.cast("bigint"), "top": empty.cast("string"), "freq": empty.cast("bigint")}
    )
    if not txt:
        return numbers
    counts = _long(df.agg(*[F.count(c).alias(f"count_{i}") for i, c in enumerate(txt)]), txt, ["count"])
    texts = counts.join(modes(df, txt), "column", "left")
    return numbers.unionByName(texts, allowMissingColumns=True)


def central(df: DataFrame, cols: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Mean, median and smallest most frequent value."""
    med = quantiles(df, cols, [0.5], task_rows=task_rows).select("column", F.col("q")[0].alias("median"))
    mode = modes(df, cols).select("column", F.col("top").cast("double").alias("mode"))
    return moments(df, cols).select("column", "mean").join(med, "column", "left").join(mode, "column", "left")


def dispersion(df: DataFrame, cols: list[str]) -> DataFrame:
    return moments(df, cols).select("column", "std", "variance", "min", "max")


def nunique(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-missing values per column; ``approx`` trades exactness for one light pass."""
    cols = cols or df.columns
    count = F.approx_count_distinct if approx else F.count_distinct
    return _long(df.agg(*[count(c).alias(f"distinct_{i}") for i, c in enumerate(cols)]), cols, ["distinct"])


def unique(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def value_counts(df: DataFrame, col: str, labels: dict | None = None) -> DataFrame:
    """``(value, count)`` in descending order, ties by value, optionally with new names."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if labels:
        table = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        counts = counts.withColumn("value", F.coalesce(F.try_element_at(table, "value"), F.col("value").cast("string")))
    return counts.orderBy(F.desc("count"), "value")


def group_stats(df: DataFrame, by: list[str], aggs: dict[str, Column], derived: dict[str, Column] | None = None) -> DataFrame:
    """Named aggregates per group plus columns derived from them."""
    out = df.groupBy(*by).agg(*[e.alias(name) for name, e in aggs.items()])
    return out.withColumns(derived) if derived else out


def group_rate(df: DataFrame, by: list[str], flag: Column) -> DataFrame:
    """Sum, count and mean of a 0/1 flag per group."""
    x = flag.cast("int")
    return df.groupBy(*by).agg(F.sum(x).alias("hits"), F.count(x).alias("count"), F.avg(x).alias("rate"))


def group_mean(df: DataFrame, by: list[str], col: str, unit: float = 1.0) -> DataFrame:
    """Scaled group means, largest first, with the global mean beside them."""
    whole = df.agg((F.avg(col) / unit).alias("m")).scalar()
    return (
        df.groupBy(*by)
        .agg((F.avg(col) / unit).alias("mean"))
        .withColumn("global_mean", whole)
        .orderBy(F.desc("mean"), *by)
    )


def group_share(df: DataFrame, by: list[str], col: str) -> DataFrame:
    """Group totals and their share of the grand total."""
    grand = df.agg(F.sum(col).alias("s")).scalar()
    return df.groupBy(*by).agg(F.sum(col).alias("total")).withColumn("share", F.try_divide(F.col("total"), grand))


def pivot_mean(df: DataFrame, rows: list[str], cols: str, val: str, values: list | None = None, max_values: int = 1000) -> DataFrame:
    """Mean of ``val`` by row key and column key; the column keys are listed, so one aggregate is enough."""
    if values is None:
        values = sorted(r[0] for r in bounded_rows(df.select(cols).where(F.col(cols).isNotNull()).distinct(), max_values, f"values of {cols}"))
    return df.groupBy(*rows).pivot(cols, list(values)).agg(F.avg(val))


def corr_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(a, b, r)`` for each pair once, pairwise complete, in one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*cells)))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """The square matrix: column ``column`` and one column per variable."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    place = {}
    for i, (a, b) in enumerate(pairs):
        place[a, b] = place[b, a] = f"r{i}"
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    aggs += [F.when(F.stddev_pop(c) > 0, F.lit(1.0)).alias(f"d{i}") for i, c in enumerate(cols)]
    place.update({(c, c): f"d{i}" for i, c in enumerate(cols)})
    cells = [F.struct(F.lit(a).alias("column"), *[F.col(place[a, b]).alias(b) for b in cols]) for a in cols]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def corr_target(df: DataFrame, cols: list[str], y: str) -> DataFrame:
    """Correlation of each column with the target, largest first."""
    aggs = [F.corr(F.col(c).cast("double"), F.col(y).cast("double")).alias(f"r_{i}") for i, c in enumerate(cols)]
    return _long(df.agg(*aggs), cols, ["r"]).orderBy(F.desc("r"), "column")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins ``(bin, low, high, n)``; the last bin is closed, empty bins are listed."""
    x = F.col(col).cast("double")
    span = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("s")).scalar()
    width = (span["hi"] - span["lo"]) / bins
    at = F.least(F.coalesce(F.floor(F.try_divide(x - span["lo"], width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = df.where(x.isNotNull()).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin",
        (span["lo"] + F.col("bin") * width).alias("low"),
        (span["lo"] + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram_lines(df: DataFrame, col: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """``(mean, median)``: the two marks drawn on a histogram."""
    median = quantiles(df, [col], [0.5], task_rows=task_rows).select(F.col("q")[0]).scalar()
    return df.agg(F.avg(col).alias("mean")).withColumn("median", median)


def box_stats(df: DataFrame, by: list[str], col: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Quartiles, whiskers and outlier count per group, ordered by median."""
    q = F.col("q")
    iqr = q[2] - q[0]
    boxes = quantiles(df, [col], [0.25, 0.5, 0.75], by, task_rows).select(
        *by,
        q[0].alias("q1"),
        q[1].alias("median"),
        q[2].alias("q3"),
        (q[0] - 1.5 * iqr).alias("__low"),
        (q[2] + 1.5 * iqr).alias("__high"),
    )
    x = F.col(col).cast("double")
    inside = x.between(F.col("__low"), F.col("__high"))
    return (
        join_null_safe(df.select(*by, col), lookup_side(boxes), by, "inner")
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.count(x).alias("n"),
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .orderBy("median", *by)
    )


def group_profile(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Group means, min-max normalised across the groups."""
    means = df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols])
    span = means.agg(
        F.struct(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols]).alias("s")
    ).scalar()
    return means.withColumns(
        {c: F.try_divide(F.col(c) - span[c]["lo"], span[c]["hi"] - span[c]["lo"]) for c in cols}
    )


def series(df: DataFrame, unit: list[str], period: Column, val: str, agg=F.sum) -> DataFrame:
    """Value by period for each unit, in period order."""
    return (
        df.groupBy(*unit, period.alias("period")).agg(agg(val).alias("value")).orderBy(*unit, "period")
    )


def quantile_class(df: DataFrame, col: str, qs: list[float], names: list[str], name: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Right-closed classes between quantiles; a missing value gets no class."""
    cuts = quantiles(df, [col], qs, task_rows=task_rows).select("q").scalar()
    cls = F.when(F.col(col).isNull(), F.lit(None))
    for i, label in enumerate(names[:-1]):
        cls = cls.when(F.col(col) <= cuts[i], F.lit(label))
    return df.withColumn(name, cls.otherwise(F.lit(names[-1])))


def median_label(df: DataFrame, col: str, name: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """1 above the median, else 0."""
    med = quantiles(df, [col], [0.5], task_rows=task_rows).select(F.col("q")[0]).scalar()
    return df.withColumn(name, (F.col(col) > med).cast("int"))


def percentile_curve(df: DataFrame, col: str, n: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """The sorted-value curve read at ``n + 1`` evenly spaced quantiles: ``(step, value)``."""
    grid = [i / n for i in range(n + 1)]
    curve = quantiles(df, [col], grid, task_rows=task_rows)
    return curve.select(F.posexplode("q").alias("step", "value"))


def scatter_sample(df: DataFrame, cols: list[str], n: int, key: str, seed: int = 42) -> DataFrame:
    """A reproducible sample of ``n`` rows for point charts, independent of partitioning."""
    ticket = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")).cast("binary"))
    return df.select(key, *cols).orderBy(ticket, key).limit(n)


def profile(df: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """One long table ``(section, column, measure, value)`` of the whole data set."""
    from .outliers import iqr_report
    from .quality import null_counts

    num, cat = numeric_cols(df), categorical_cols(df)

    def part(section, table, measures):
        cells = [F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
        return table.select(F.lit(section).alias("section"), "column", F.inline(F.array(*cells)))

    dims = shape(df).withColumn("column", F.lit("*")).withColumns(
        {"numeric": F.lit(len(num)), "categorical": F.lit(len(cat))}
    )
    parts = [
        part("shape", dims, ["rows", "columns", "cells", "numeric", "categorical"]),
        part("missing", null_counts(df), ["missing", "percent"]),
        part("distinct", nunique(df), ["distinct"]),
    ]
    if num:
        parts.append(part("numeric", describe(df, num, task_rows), ["mean", "std", "min", "q25", "q50", "q75", "max"]))
        parts.append(part("outliers", iqr_report(df, num, task_rows), ["outliers"]))
    if len(num) > 1:
        pairs = corr_pairs(df, num).select(F.concat_ws("~", "a", "b").alias("column"), F.col("r"))
        parts.append(part("correlation", pairs, ["r"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
