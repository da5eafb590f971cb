"""Readers and writers: CSV and Parquet tables, fitted models, metric summaries."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN in floating point columns becomes NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line, UTF-8, a declared schema, and empty fields as missing."""
    reader = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
    return nan_to_null(reader.option("enforceSchema", False).option("mode", "FAILFAST").csv(path))


def load_parquet(spark: SparkSession, directory: str, name: str, nan_as_null: bool = True) -> DataFrame:
    """A table of a directory of Parquet tables; column pruning and filters reach the scan.

    NaN becomes NULL as in every loader.  A filter on a floating point column then runs above the
    scan; tables known to hold no NaN can do without.
    """
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return nan_to_null(df) if nan_as_null else df


def load_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> tuple[DataFrame, dict]:
    """Read a CSV (with ``schema``) or Parquet table and report its size.

    A missing path fails here, before any later step is planned.
    """
    df = spark.read.parquet(path) if schema is None else read_csv(spark, path, schema)
    return df, {"path": path, "rows": df.count(), "columns": len(df.columns)}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Distributed CSV output with a header in each part file."""
    df.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Run summary as JSON lines; the metrics frame has a handful of rows, hence one file."""
    metrics.coalesce(1).write.mode(mode).json(path)
