"""Searches from fold sums against fits on the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from calibra.operators import fold_search as S, search as H


def rows(seed, n=240, dims=2):
    rng = np.random.default_rng(seed)
    x = rng.uniform(-2, 3, (n, dims))
    y = 1 + 2 * x[:, 0] - x[:, -1] ** 2 + 0.5 * x[:, 0] * x[:, -1] + rng.normal(0, 0.3, n)
    return x, y, rng.integers(0, 4, n)


def frame(spark, x, y, fold):
    data = [([float(v) for v in a], float(b), int(f), "s") for a, b, f in zip(x, y, fold)]
    return spark.createDataFrame(data, "x array<double>, y double, fold int, other string")


def plain_terms(x, degree):
    return np.column_stack([np.prod(x[:, list(t)], axis=1) for t in S.term_list(x.shape[1], degree)])


def plain_fit(model, z, y, a):
    """Slopes on standardised terms by other means: a linear solve, or many steps of proximal gradient."""
    n = len(y)
    if model == "ridge":
        return np.linalg.solve(z.T @ z + a * np.eye(z.shape[1]), z.T @ (y - y.mean()))
    b, step = np.zeros(z.shape[1]), n / np.linalg.norm(z, 2) ** 2
    for _ in range(60_000):
        b = b + step * z.T @ (y - y.mean() - z @ b) / n
        b = np.sign(b) * np.maximum(np.abs(b) - step * a, 0)
    return b


def plain_scores(model, degree, a, x, y, fold):
    terms, out = plain_terms(x, degree), []
    for f in range(4):
        train, test = fold != f, fold == f
        mean, dev = terms[train].mean(axis=0), terms[train].std(axis=0)
        b = plain_fit(model, (terms[train] - mean) / dev, y[train], a)
        guess = y[train].mean() + (terms[test] - mean) / dev @ b
        out.append(1 - ((y[test] - guess) ** 2).sum() / ((y[test] - y[test].mean()) ** 2).sum())
    return np.mean(out), np.std(out)


def test_scores_are_those_of_fits_on_rows(spark):
    x, y, fold = rows(1)
    sums = S.fold_sums(frame(spark, x, y, fold).repartition(3), "x", "y", "fold", 4, 4)
    candidates = [(m, d, a) for m in ("ridge", "lasso") for d in (1, 2, 3) for a in (1e-2, 0.1, 3.0)] + [("ridge", 4, 1.0)]
    found = S.search(spark, sums, candidates)
    got = {r["candidate"]: r for r in found.table.collect()}
    for i, (m, d, a) in enumerate(candidates):
        assert (got[i]["mean"], got[i]["std"]) == pytest.approx(plain_scores(m, d, a, x, y, fold), abs=1e-6), (m, d, a)
    best = max(got.values(), key=lambda r: r["mean"])
    assert best["best"] and (found.model, found.degree, found.strength) == (best["model"], best["degree"], best["strength"])


def test_refit_predicts_as_the_rows_do(spark):
    x, y, fold = rows(2)
    df = frame(spark, x, y, fold)
    sums = S.fold_sums(df, "x", "y", "fold", 4, 3)
    terms = plain_terms(x, 3)
    for model, a in (("ridge", 0.5), ("lasso", 0.05)):
        mean, dev = terms.mean(axis=0), terms.std(axis=0)
        want = y.mean() + (terms - mean) / dev @ plain_fit(model, (terms - mean) / dev, y, a)
        got = [r["p"] for r in df.select(S.predicted("x", *S.refit(sums, model, 3, a)).alias("p")).collect()]
        assert got == pytest.approx(want.tolist(), abs=1e-6)


def test_high_degrees_and_many_draws(spark):
    x, y, fold = rows(3, n=400, dims=1)
    sums = S.fold_sums(frame(spark, x * 50, y, fold), "x", "y", "fold", 4, 9)
    found = S.search(spark, sums, S.draws(200, 5, "ridge", list(range(2, 10)), H.log_uniform(1e-5, 1e3)))
    table = found.table.collect()
    assert len(table) == 200 and sum(r["best"] for r in table) == 1
    for r in table[::20]:
        assert r["mean"] == pytest.approx(plain_scores("ridge", r["degree"], r["strength"], x * 50, y, fold)[0], abs=1e-4)
    assert S.better(found, found) is found


def test_rows_that_take_no_part(spark):
    x, y, fold = rows(4)
    data = frame(spark, x, y, fold)
    odd = spark.createDataFrame(
        [(None, 1.0, 0, ""), ([1.0, None], 1.0, 0, ""), ([1.0, float("nan")], 1.0, 0, ""), ([1.0, 2.0], None, 0, ""), ([1.0, 2.0], 1.0, None, ""), ([1.0, 2.0], 1.0, 9, "")],
        data.schema,
    )
    one, two = (S.fold_sums(d, "x", "y", "fold", 4, 2).sums for d in (data, data.unionByName(odd)))
    assert np.allclose(one, two)
    constant = data.withColumn("x", F.array(F.get("x", F.lit(0)), F.lit(7.0)))
    found = S.search(spark, S.fold_sums(constant, "x", "y", "fold", 4, 1), [("ridge", 1, 1.0), ("lasso", 1, 0.01)])
    assert all(np.isfinite(r["mean"]) for r in found.table.collect())
    with pytest.raises(ValueError):
        S.fold_sums(data, "x", "y", "fold", 4, 60)
