"""Side-by-side comparison of a registered query with its SQL statement in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(directory: str):
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _kind(value):
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    return type(value).__name__


def _canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_canonical(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both sides agree on names, value kinds, row count and all values."""
    names = spark_df.columns
    mine = [tuple(r) for r in spark_df.collect()]
    cursor = con.execute(sql)
    other_names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(other_names):
        return f"columns {sorted(names)} vs {sorted(other_names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    for n in names:
        i, j = names.index(n), other_names.index(n)
        kinds = {_kind(r[i]) for r in mine} - {"null"}, {_kind(r[j]) for r in theirs} - {"null"}
        if kinds[0] != kinds[1]:
            return f"column {n}: kinds {kinds}"
    a, b = canonical_rows(names, mine), canonical_rows(other_names, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, columns {sorted(names)}, first {bad[0]}"
    return None
