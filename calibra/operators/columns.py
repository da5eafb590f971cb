"""Projection, filters, conversions and per-column text and number helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.sizing import bounded_rows, lookup_side

NOMINAL_KEY = "categories"
_MAP_LITERAL_SIZE = 200


def head(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-k, never a full sort)."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Last ``n`` rows in an explicit order."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def reorder(df: DataFrame, first: list[str] = (), last: list[str] = ()) -> DataFrame:
    """Move columns to the front or to the end, keeping the order of the others."""
    moved = {*first, *last}
    return df.select(*first, *[c for c in df.columns if c not in moved], *last)


def drop_cols(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*cols)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def clean_names(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """Rewrite every column name with ``(pattern, replacement)`` rules applied in turn."""

    def clean(name: str) -> str:
        for pattern, replacement in rules:
            name = re.sub(pattern, replacement, name)
        return name

    return df.toDF(*[clean(c) for c in df.columns])


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def categorical_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not isinstance(f.dataType, T.NumericType)]


def derive(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    """Add derived columns in one projection."""
    return df.withColumns(exprs)


def ratio(a: str, b: str) -> Column:
    """``a / b``; a zero divisor gives a missing value instead of an error."""
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def scale_unit(df: DataFrame, col: str, unit: float, name: str | None = None) -> DataFrame:
    """Express a measure in a larger unit."""
    return df.withColumn(name or col, F.col(col) / F.lit(float(unit)))


def between(df: DataFrame, col: str, low, high) -> DataFrame:
    """Keep rows inside the closed range."""
    return df.where(F.col(col).between(low, high))


def isin(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(F.col(col).isin(list(values)))


def drop_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Drop the rows whose key is in ``keys``."""
    return df.join(lookup_side(keys.select(*on).distinct()), on, "left_anti")


def cast_cols(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def to_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text to number; text that is no number, "nan" included, becomes missing."""
    missing = F.lit(None).cast("double")
    return df.withColumns({c: F.nanvl(F.trim(F.col(c)).try_cast("double"), missing) for c in cols})


def as_category(df: DataFrame, cols: list[str], max_levels: int = 10_000) -> DataFrame:
    """Mark text columns as categorical: the sorted levels go into the column's metadata."""
    for c in cols:
        levels = df.select(F.col(c).cast("string").alias(c)).where(F.col(c).isNotNull()).distinct()
        names = sorted(r[0] for r in bounded_rows(levels, max_levels, f"levels of {c}"))
        df = df.withColumn(c, F.col(c).cast("string")).withMetadata(c, {NOMINAL_KEY: names})
    return df


def categories(df: DataFrame, col: str) -> list[str]:
    """The levels recorded by :func:`as_category`."""
    return df.schema[col].metadata[NOMINAL_KEY]


def _common_type(spark, values: list) -> T.DataType:
    """The type Spark gives an array of the values; of each Python type the extremes stand for all."""
    by_type = {}
    for v in values:
        by_type.setdefault(type(v), []).append(v)
    few = [x for found in by_type.values() for x in ({min(found), max(found)} if found[0] is not None else {None})]
    return spark.range(0).select(F.array(*[F.lit(v) for v in few]).alias("a")).schema["a"].dataType.elementType


def map_values(df: DataFrame, col: str, mapping: dict, name: str | None = None) -> DataFrame:
    """Translate codes; a code without a translation becomes missing.

    The result has the type that holds all values, however many there are.
    """
    name = name or col
    key_type, value_type = df.schema[col].dataType, _common_type(df.sparkSession, list(mapping.values()))
    if len(mapping) <= _MAP_LITERAL_SIZE:
        table = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (k, v)])
        return df.withColumn(name, F.try_element_at(table, F.col(col)).cast(value_type))
    schema = T.StructType([T.StructField("__code", key_type), T.StructField("__value", value_type)])
    convert = float if isinstance(value_type, T.DoubleType) else str if isinstance(value_type, T.StringType) else lambda v: v
    rows = [(k, None if v is None else convert(v)) for k, v in mapping.items()]
    pairs = lookup_side(df.sparkSession.createDataFrame(rows, schema))
    joined = df.join(pairs, df[col] == pairs["__code"], "left")
    return joined.withColumn(name, F.col("__value")).drop("__code", "__value")


def clean_text(col: str | Column) -> Column:
    """Trim and collapse runs of white space to one blank."""
    c = F.col(col) if isinstance(col, str) else col
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def prefix_class(col: str, pattern: str, default: str = "X") -> Column:
    """First character when the text starts with ``pattern``, otherwise ``default``."""
    return F.when(F.col(col).rlike("^" + pattern), F.substring(col, 1, 1)).otherwise(F.lit(default))


def round_cols(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def describe_columns(df: DataFrame, descriptions: dict[str, str]) -> DataFrame:
    """Attach a data dictionary as column comments."""
    for c, text in descriptions.items():
        df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return df


def data_dictionary(df: DataFrame) -> DataFrame:
    """The attached data dictionary as a table, in column order."""
    rows = [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "column string, type string, comment string")


def drop_constant(df: DataFrame) -> DataFrame:
    """Drop columns with at most one distinct value, missing values not counted."""
    spread = df.agg(*[(F.min(c) != F.max(c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if spread[c]])
