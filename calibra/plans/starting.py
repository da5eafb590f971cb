"""k-means from many starts, over ranges of k and on resamples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C, starts as S
from .registry import query

SEEDS = list(range(100))


def _vectors(t):
    return t("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))


def _lines(t, groups=3):
    """Groups of customers a hundred units apart."""
    group = F.col("c_custkey") % groups
    return t("customer").select("c_custkey", F.array(group * 100.0, F.col("c_nationkey") * 0.25).alias("x"))


@query("kmeans_seeds")
def kmeans_seeds(t):
    """A hundred starts of ten clusters."""
    return S.kmeans_starts(_vectors(t), "vec_id", "x", [10], SEEDS)[1]


_WITHIN = """WITH p AS (SELECT c_custkey % 3 AS g, c_nationkey * 0.25 AS y FROM customer)"""


@query("kmeans_seeds_separated", f"{_WITHIN} SELECT round(sum(s), 4) AS inertia, 100::BIGINT AS starts FROM (SELECT var_pop(y) * count(*) AS s FROM p GROUP BY g)")
def kmeans_seeds_separated(t):
    """The best of a hundred starts finds the groups."""
    table = S.kmeans_starts(_lines(t), "c_custkey", "x", [3], SEEDS)[1]
    best = table.agg(F.max(F.when(F.col("best"), F.col("inertia"))).alias("inertia"), F.count(F.lit(1)).alias("starts"))
    return C.round_cols(best, ["inertia"], 4)


@query("elbow_range")
def elbow_range(t):
    """Inertia of the best of ten starts for k from 1 to 10."""
    return S.kmeans_starts(_vectors(t), "vec_id", "x", list(range(1, 11)), SEEDS[:10])[1].where("best")


@query(
    "elbow_range_total",
    """SELECT 1 AS k, round(10000.0 * var_pop(c_custkey % 3) * count(*) + 0.0625 * var_pop(c_nationkey) * count(*), 2) AS inertia FROM customer
        UNION ALL SELECT 3, (SELECT round(sum(s), 2) FROM (SELECT 0.0625 * var_pop(c_nationkey) * count(*) AS s FROM customer GROUP BY c_custkey % 3))""",
)
def elbow_range_total(t):
    """One cluster has the sum of squares around the mean, three the sums around their groups' means."""
    table = S.kmeans_starts(_lines(t), "c_custkey", "x", list(range(1, 6)), SEEDS[:20])[1]
    return C.round_cols(table.where("best and k in (1, 3)").select("k", "inertia"), ["inertia"], 2)


@query("stability_rounds")
def stability_rounds(t):
    """Thirty resamples, five starts each."""
    return S.stability_rounds(_vectors(t), "vec_id", "x", 10, 30, SEEDS[:5])[0]


@query("stability_rounds_separated", "SELECT 1.0::DOUBLE AS mean, 0.0::DOUBLE AS std, 30::BIGINT AS rounds FROM customer LIMIT 1")
def stability_rounds_separated(t):
    return C.round_cols(S.stability_rounds(_lines(t), "c_custkey", "x", 3, 30, SEEDS[:10])[0], ["mean", "std"], 9)
