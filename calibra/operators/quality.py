"""Missing values, duplicates, rules and text audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .columns import clean_text


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, missing, percent)`` for every column, from one pass."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"m{i}").alias("missing"),
            F.try_divide(F.lit(100.0) * F.col(f"m{i}"), F.col("n")).alias("percent"),
        )
        for i, c in enumerate(df.columns)
    ]
    return wide.select(F.inline(F.array(*cells)))


def null_report(df: DataFrame) -> DataFrame:
    """Columns that have missing values, with count and percentage."""
    return null_counts(df).where("missing > 0")


def null_total(df: DataFrame) -> DataFrame:
    """Total number of missing cells and whether there is any."""
    total = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("bigint") for c in df.columns])
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("missing")).select("missing", (F.col("missing") > 0).alias("any_missing"))


def drop_null(df: DataFrame, how: str = "any", thresh: int | None = None, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with any missing, all missing, or fewer than ``thresh`` present values."""
    return df.dropna(how=how, thresh=thresh, subset=subset)


def drop_null_cols(df: DataFrame) -> DataFrame:
    """Drop every column that has a missing value."""
    complete = df.agg(*[(F.count_if(F.col(c).isNull()) == 0).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if complete[c]])


def dup_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each key (or of each whole row)."""
    copies = df.groupBy(*(keys or df.columns)).agg((F.count(F.lit(1)) - 1).alias("extra"))
    return copies.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicates"))


def dedupe(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """Remove exact duplicates, or keep the first row of each key in an explicit order.

    The keyed form is an aggregate with map-side combine, so a hot key costs no extra memory.
    """
    if keys is None:
        return df.dropDuplicates()
    if not order:
        raise ValueError("keeping the first row of a key needs an explicit order")
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
    return kept.select(*[F.col("__row")[c].alias(c) for c in df.columns])


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``(rule, violations)``: rows for which each violation condition is true, in one pass."""
    wide = df.agg(*[F.count_if(cond).alias(f"v{i}") for i, cond in enumerate(rules.values())])
    cells = [F.struct(F.lit(name).alias("rule"), F.col(f"v{i}").alias("violations")) for i, name in enumerate(rules)]
    return wide.select(F.inline(F.array(*cells)))


def check_identity(df: DataFrame, col: str, expr: Column) -> DataFrame:
    """Largest absolute difference between a stated column and its recomputation."""
    return df.agg(F.max(F.abs(F.col(col) - expr)).alias("max_difference"))


def text_audit(df: DataFrame, col: str) -> DataFrame:
    """Distinct raw texts beside their cleaned form, and whether cleaning changed them."""
    pairs = df.select(F.col(col).alias("raw"), clean_text(col).alias("cleaned")).distinct()
    return pairs.withColumn("changed", F.col("raw") != F.col("cleaned"))
