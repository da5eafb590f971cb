"""Registered queries: an operator bound to the tables, with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load_parquet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Access to the tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __call__(self, name: str) -> DataFrame:
        # The tables hold no NaN, so filters on floating point columns reach the scan.
        return load_parquet(self.spark, self.directory, name, nan_as_null=False)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is its independent statement."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, directory: fn(Tables(spark, directory))
        if sql:
            SQL[name] = sql
        return fn

    return register
