"""Helpers of the operators in this package."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sizing import scratch_path


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet, so that columns of the caller never clash."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(key: str, text: str) -> tuple[Column, Column]:
    """Two never-null columns that tell rows apart by id and text.

    Rows that repeat both have the same result in every operator that joins on this pair.
    """
    return F.coalesce(F.col(key).cast("bigint"), F.lit(0)), F.xxhash64(F.col(text))


def slices(frames: Iterator[pd.DataFrame], column: str, chars: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """The rows of ``frames`` in parts of about ``chars`` characters of a text column, one row at least."""
    for frame in frames:
        part = frame[column].str.len().fillna(0).cumsum().floordiv(chars)
        for _, rows in frame.groupby(part.to_numpy(), sort=False):
            yield rows


def give_back() -> None:
    """Return freed memory of a worker that lives on after its task to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
