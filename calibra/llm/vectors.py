"""Checks on embedding columns that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there, without missing or non-finite components, and not zero."""
    big = F.lit(float("inf"))
    return F.coalesce(
        vector.isNotNull()
        & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big))
        & F.exists(vector, lambda v: v != 0),
        F.lit(False),
    )
