"""Size checks that decide between a cheap plan and a plan that holds at any size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A side with at most this many rows may be broadcast.
BROADCAST_ROWS = 100_000
# Its text and nested columns may hold at most this many bytes in all.
BROADCAST_BYTES = 64 << 20
# A window or a percentile state may hold at most this many rows in one task.
TASK_ROWS = 2_000_000

_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def lookup_side(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Prepare the small side of a join.

    At most ``max_rows + 1`` rows are read.  When they fit they become a broadcast table, so the
    large side is not shuffled; when they do not, the frame is given back unchanged and the join
    stays a shuffle join (adaptive execution splits hot keys).  Where values have no fixed width,
    their bytes are added up by the executors first, and nothing is fetched above ``max_bytes``.
    """
    wide, first = [f.name for f in df.schema if not isinstance(f.dataType, _FIXED)], df.limit(max_rows + 1)
    if wide:
        # Kept by the executors between the two looks at it.
        first = first.persist()
        held = first.agg(F.sum(F.octet_length(F.to_json(F.struct(*wide))).cast("bigint"))).first()[0]
        if (held or 0) > max_bytes:
            first.unpersist()
            return df
    rows = first.collect()
    if wide:
        first.unpersist()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def bounded_rows(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect a result whose size is bounded by design, failing loudly when it is not."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows, too many to hold on the driver")
    return rows


def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where two missing keys count as equal; keys come from ``left``."""
    keys = list(keys)
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    One of our own is set only where neither the session nor its configuration has one and driver
    and executors are one process, as in a local test; on a cluster a missing folder is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="calibra-checkpoint-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_sizes(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: lineage and estimated size end here.

    A checkpoint keeps the estimate of its plan, and a join's estimate is the product of its sides.  In a loop the
    digits of that number double with each round, until the numbers alone fill the driver.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
