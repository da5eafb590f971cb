"""Searches of full size: every candidate from one pass over the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as C, fold_search as S, search as H
from ..operators.splits import folds
from .registry import query

FOLDS, DRAWS, SEED = 4, 200, 7
SMALL, WIDE = (1e-5, 1e3), (1e-2, 1e2)
_SQL = """WITH d AS (SELECT c_nationkey::DOUBLE AS x, c_acctbal + 20.0 * c_nationkey * c_nationkey AS y,
      ntile({folds}) OVER (ORDER BY md5(c_custkey::VARCHAR || '|42')) - 1 AS fold FROM customer),
    listed(candidate, degree, a) AS (VALUES {listed}),
    train AS (SELECT f.fold, count(*) AS n, avg(x) AS m1, avg(x * x) AS m2, avg(y) AS my, stddev_pop(x) AS s1, stddev_pop(x * x) AS s2,
      covar_pop(x, y) / stddev_pop(x) AS r1, covar_pop(x * x, y) / stddev_pop(x * x) AS r2, corr(x, x * x) AS c
      FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
    fit AS (SELECT *, {slopes} FROM train, listed),
    scored AS (SELECT candidate, d.fold, 1 - sum((y - my - b1 * (x - m1) / s1 - b2 * (x * x - m2) / s2)**2) / (var_pop(y) * count(*)) AS r2
      FROM d JOIN fit USING (fold) GROUP BY candidate, d.fold),
    means AS (SELECT candidate, avg(r2) AS mean, stddev_pop(r2) AS std FROM scored GROUP BY candidate)"""
_RIDGE = """CASE WHEN degree = 1 THEN r1 / (1 + a / n) ELSE ((1 + a / n) * r1 - c * r2) / ((1 + a / n)**2 - c * c) END AS b1,
    CASE WHEN degree = 1 THEN 0 ELSE ((1 + a / n) * r2 - c * r1) / ((1 + a / n)**2 - c * c) END AS b2"""
_LASSO = "sign(r1) * greatest(abs(r1) - a, 0) AS b1, 0.0 AS b2"
_TABLE = """SELECT candidate::INT AS candidate, degree::INT AS degree, round(mean, 6) AS mean, round(std, 6) AS std,
    candidate = (SELECT candidate FROM means ORDER BY mean DESC, candidate LIMIT 1) AS best FROM means JOIN listed USING (candidate)"""


def _drawn(model, degrees, reach):
    return S.draws(DRAWS, SEED, model, degrees, H.log_uniform(*reach))


def _sql(candidates, slopes):
    listed = ", ".join(f"({i}, {d}, {a!r}::DOUBLE)" for i, (_, d, a) in enumerate(candidates))
    return _SQL.format(folds=FOLDS, listed=listed, slopes=slopes)


def _sums(t, degree):
    y = F.col("c_acctbal") + 20.0 * F.col("c_nationkey") * F.col("c_nationkey")
    df = t("customer").select("c_custkey", F.array(F.col("c_nationkey").cast("double")).alias("x"), y.alias("y"))
    return S.fold_sums(folds(df, "c_custkey", FOLDS, 42), "x", "y", "fold", FOLDS, degree)


def _table(found):
    return C.round_cols(found.table.select("candidate", "degree", "mean", "std", "best"), ["mean", "std"], 6)


_RIDGES, _LASSOS = _drawn("ridge", [1, 2], WIDE), _drawn("lasso", [1], SMALL)


@query("fold_search_ridge", f"{_sql(_RIDGES, _RIDGE)} {_TABLE}")
def fold_search_ridge(t):
    """200 draws of degree 1 or 2 and of strength, in four folds."""
    return _table(S.search(t.spark, _sums(t, 2), _RIDGES))


@query("fold_search_lasso", f"{_sql(_LASSOS, _LASSO)} {_TABLE}")
def fold_search_lasso(t):
    return _table(S.search(t.spark, _sums(t, 1), _LASSOS))


def _text_sums(t):
    """Mean word length from the length of the text, degrees 1 to 9."""
    words = F.greatest(F.size(F.split(F.trim("text"), r"\s+")), F.lit(1))
    docs = t("documents").select("doc_id", F.array(F.log1p(F.length("text"))).alias("x"), (F.length("text") / words).alias("y"))
    return S.fold_sums(folds(docs, "doc_id", FOLDS, 42), "x", "y", "fold", FOLDS, 9)


@query("fold_search_degrees")
def fold_search_degrees(t):
    """200 draws of ridge and 200 of lasso over degrees 2 to 9, in four folds: 1,600 fits."""
    sums, degrees = _text_sums(t), list(range(2, 10))
    found = [S.search(t.spark, sums, _drawn(m, degrees, SMALL)) for m in ("ridge", "lasso")]
    return found[0].table.unionByName(found[1].table).withColumn("chosen", F.col("best") & (F.col("model") == S.better(*found).model))
