"""Queries over fitted models and clusterings whose results have a closed form that SQL can state.

Customers are points ``(1000 * segment number, nation)``: five groups far apart, whose sizes, means
and sums of squares a grouping gives.  Models see one indicator or one number, so that group rates,
slopes and fold scores are sums over the table.
"""

from __future__ import annotations

import random

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from ..functions.sizing import scratch_path
from ..operators import clusters as K, columns as C, density as G, labels as L, metrics as E, models as M, search as H
from ..operators.splits import folds
from ..sources import tables as S
from .modelling import _documents, _one, _prepared
from .registry import query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_NUMBER = f"(list_position({SEGMENTS!r}, c_mktsegment) - 1)"
POINTS = f"points AS (SELECT c_custkey, {_NUMBER} AS g, 1000.0 * {_NUMBER} AS x0, c_nationkey::DOUBLE AS x1 FROM customer)"
# Points are few, customers many: distances between distinct points, with the number of customers at each.
SILHOUETTE = f"""{POINTS}, spots AS (SELECT {{c}} AS c, x0, x1, count(*) AS w FROM points GROUP BY ALL),
  away AS (SELECT a.c, a.x0, a.x1, a.w, b.c AS other, sum(b.w * sqrt((a.x0 - b.x0)**2 + (a.x1 - b.x1)**2)) AS d, sum(b.w) AS n
           FROM spots a JOIN spots b ON true GROUP BY ALL),
  judged AS (SELECT any_value(w) AS w, max(d / (n - 1)) FILTER (WHERE other = c) AS own, min(d / n) FILTER (WHERE other <> c) AS next
             FROM away GROUP BY c, x0, x1),
  scored AS (SELECT sum(w * (next - own) / greatest(next, own)) / sum(w) AS silhouette FROM judged)"""


def _points(t):
    number = F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("c_mktsegment")).cast("int") - 1
    customers = t("customer").select("c_custkey", "c_nationkey", number.alias("g"))
    return customers.withColumn("x", F.array(F.col("g") * 1000.0, F.col("c_nationkey").cast("double")))


def _found(t, assigned):
    """Clusters by the groups that they hold, as their numbers are arbitrary."""
    both = _points(t).join(assigned.select("c_custkey", "cluster"), "c_custkey")
    found = both.groupBy("cluster").agg(F.min("g").alias("first"), F.max("g").alias("last"), F.count(F.lit(1)).alias("n"))
    return found.drop("cluster")


_GROUPS = f"WITH {POINTS} SELECT g::INT AS first, g::INT AS last, count(*) AS n FROM points GROUP BY g"
_INERTIA = "count(*) * (var_pop(x0) + var_pop(x1))"


# --- clusters ---------------------------------------------------------------------------


@query("kmeans_separated", _GROUPS)
def kmeans_separated(t):
    return _found(t, K.kmeans(_points(t), "c_custkey", "x", 5, list(range(8)))[0])


@query("kmeans_aligned_separated", f"WITH {POINTS} SELECT g::INT AS g, g::INT AS cluster, count(*) AS n FROM points GROUP BY g")
def kmeans_aligned_separated(t):
    aligned = K.kmeans_aligned(_points(t), "c_custkey", "x", "g", list(range(8)), k=5)
    return aligned.groupBy("g", "cluster").agg(F.count(F.lit(1)).alias("n"))


@query(
    "elbow_separated",
    f"""WITH {SILHOUETTE.format(c='g')}
        SELECT 1 AS k, round({_INERTIA}, 3) AS inertia, NULL::DOUBLE AS silhouette, false AS best FROM points
        UNION ALL SELECT 5, round(sum(i), 3), (SELECT round(silhouette, 6) FROM scored), true FROM (SELECT {_INERTIA} AS i FROM points GROUP BY g)""",
)
def elbow_separated(t):
    return C.round_cols(C.round_cols(K.elbow(_points(t), "c_custkey", "x", [1, 5], list(range(8))), ["inertia"], 3), ["silhouette"], 6)


@query("fuzzy_separated", f"WITH {POINTS} SELECT (g >= 3)::INT AS first, (g >= 3)::INT AS last, count(*) AS n FROM points GROUP BY g >= 3")
def fuzzy_separated(t):
    """Two groups far apart: three segments and two."""
    points = _halves(t)
    assigned, _ = K.fuzzy_cmeans(points, "c_custkey", "x", 2, seed=42)
    both = points.join(assigned.select("c_custkey", "cluster"), "c_custkey").groupBy("cluster")
    return both.agg(F.min("half").alias("first"), F.max("half").alias("last"), F.count(F.lit(1)).alias("n")).drop("cluster")


def _halves(t):
    half = (F.col("g") >= 3).cast("int")
    return _points(t).withColumn("half", half).withColumn("x", F.array(half * 1000.0, F.col("c_nationkey").cast("double")))


@query(
    "fuzzy_select_separated",
    f"""WITH {SILHOUETTE.format(c='(g >= 3)::INT').replace(f"1000.0 * {_NUMBER}", f"1000.0 * ({_NUMBER} >= 3)::INT")}
        SELECT 2 AS c, 2::BIGINT AS clusters, round(silhouette, 6) AS silhouette FROM scored""",
)
def fuzzy_select_separated(t):
    """The best number of clusters is the number of groups."""
    scores, _ = K.fuzzy_select(_halves(t), "c_custkey", "x", [2, 3, 4], seed=42)
    return C.round_cols(scores.orderBy(F.desc_nulls_last("silhouette"), "c").limit(1), ["silhouette"], 6)


@query("stability_separated", "SELECT 1.0::DOUBLE AS mean, 0.0::DOUBLE AS std, 5::BIGINT AS rounds FROM customer LIMIT 1")
def stability_separated(t):
    """Samples of groups far apart are cut as the whole is."""
    points = _points(t).select("c_custkey", "x")

    def fit(sample, seed):
        return K.kmeans(sample, "c_custkey", "x", 5, [seed + i for i in range(4)])[0]

    return C.round_cols(L.stability(points, "c_custkey", fit(points, 42), fit, rounds=5, seed=42)[0], ["mean", "std"], 9)


@query(
    "dbscan_sweep_separated",
    f"""WITH {SILHOUETTE.format(c='g')}
        SELECT eps, m::INT AS min_samples, CASE WHEN eps < 1000 THEN 5 ELSE 1 END::BIGINT AS clusters, 1.0::DOUBLE AS clustered_share,
          CASE WHEN eps < 1000 THEN round(silhouette, 6) END AS silhouette, eps = 30 AND m = 3 AS chosen
        FROM scored, (VALUES (30.0::DOUBLE), (60.0), (1100.0)) AS e(eps), (VALUES (3), (5)) AS s(m)""",
)
def dbscan_sweep_separated(t):
    """Radii that reach through a group give the groups, one that reaches the next group a single cluster."""
    scores = G.dbscan_sweep(_points(t), "c_custkey", "x", [30.0, 60.0, 1100.0], [3, 5])
    return C.round_cols(scores.select("eps", "min_samples", "clusters", "clustered_share", "silhouette", "chosen"), ["silhouette"], 6)


@query("micro_agglomerative_separated", _GROUPS)
def micro_agglomerative_separated(t):
    """The best cut of the merged micro-clusters is the groups."""
    _, assigned = K.micro_agglomerative(_points(t), "c_custkey", "x", "average", list(range(2, 9)), m=48, seed=42)
    return _found(t, assigned)


@query(
    "ward_heights",
    "SELECT count(*) - 1 AS merges, count(*) AS size, round(count(*) * (var_pop(n_nationkey) + var_pop(n_regionkey)), 6) AS half_squares FROM nation",
)
def ward_heights(t):
    """Each row its own micro-cluster: half the squared Ward heights add up to the total sum of squares."""
    x = F.array(F.col("n_nationkey").cast("double"), F.col("n_regionkey").cast("double"))
    merges = K.merge_table(t("nation").select("n_nationkey", x.alias("x"), F.col("n_nationkey").cast("int").alias("micro")), "n_nationkey", "ward")
    out = merges.agg(
        F.count(F.lit(1)).alias("merges"), F.max("size").alias("size"), (F.sum(F.col("distance") * F.col("distance")) / 2).alias("half_squares")
    )
    return C.round_cols(out, ["half_squares"], 6)


@query(
    "ward_heights_customers",
    """WITH p AS (SELECT c_nationkey * 5 + ascii(c_mktsegment) % 5 AS micro, c_acctbal / 1000 AS x, c_nationkey::DOUBLE AS y FROM customer),
        g AS (SELECT count(*) AS n, avg(x) AS x, avg(y) AS y FROM p GROUP BY micro)
        SELECT (SELECT count(*) FROM g) - 1 AS merges, (SELECT count(*) FROM p) AS size,
            round((SELECT sum(n * ((g.x - m.x)**2 + (g.y - m.y)**2)) FROM g, (SELECT avg(x) AS x, avg(y) AS y FROM p) m), 4) AS half_squares""",
)
def ward_heights_customers(t):
    """Micro-clusters by nation and segment: half the squared Ward heights add up to the sum of squares between them."""
    micro = (F.col("c_nationkey") * 5 + F.ascii("c_mktsegment") % 5).cast("int").alias("micro")
    x = F.array(F.col("c_acctbal") / 1000, F.col("c_nationkey").cast("double")).alias("x")
    merges = K.merge_table(t("customer").select("c_custkey", x, micro), "c_custkey", "ward")
    out = merges.agg(
        F.count(F.lit(1)).alias("merges"), F.max("size").alias("size"), (F.sum(F.col("distance") * F.col("distance")) / 2).alias("half_squares")
    )
    return C.round_cols(out, ["half_squares"], 4)


@query("best_linkage_separated", _GROUPS)
def best_linkage_separated(t):
    """Three linkages and two to eight groups: the groups win."""
    _, assigned = K.best_linkage(_points(t), "c_custkey", "x", ["ward", "average", "complete"], list(range(2, 9)), m=48, seed=42)
    return _found(t, assigned)


# --- models -----------------------------------------------------------------------------


def _indicator(t):
    """One indicator, a two-class label and a number to predict."""
    x = (F.col("l_quantity") >= 25).cast("double").alias("x")
    label = (F.col("l_quantity") * F.col("l_discount") > 1.005).cast("double").alias("label")
    return t("lineitem").select(x, label, F.col("l_extendedprice").alias("price"))


_INDICATOR = "(SELECT (l_quantity >= 25)::INT::DOUBLE AS x, (l_quantity * l_discount > 1.005)::INT AS y, l_extendedprice AS price FROM lineitem)"
_RATES = f"SELECT x, round(avg(y), 6) AS p1, count(*) AS n FROM {_INDICATOR} GROUP BY x"
_MEANS = f"SELECT x, round(avg(price), 4) AS prediction, count(*) AS n FROM {_INDICATOR} GROUP BY x"


def _rates(t, estimator):
    df = _one(_indicator(t), "x")
    scored = M.score(estimator.fit(df), df, ["x"], 2)
    return scored.groupBy("x", F.round("p1", 6).alias("p1")).agg(F.count(F.lit(1)).alias("n"))


def _means(t, estimator):
    df = _one(_indicator(t), "x")
    scored = M.score(estimator.fit(df), df, ["x"])
    return scored.groupBy("x", F.round("prediction", 4).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("forest_rates", _RATES)
def forest_rates(t):
    """Trees over all rows and one split are alike, and so is their mean."""
    return _rates(t, M.forest_classifier(trees=50, max_depth=1, bootstrap=False))


@query("forest_means", _MEANS)
def forest_means(t):
    return _means(t, M.forest_regressor(trees=50, max_depth=1, bootstrap=False, labelCol="price"))


@query("boosting_rates", f"SELECT x, round(1 / (1 + exp(-2 * (2 * avg(y) - 1))), 6) AS p1, count(*) AS n FROM {_INDICATOR} GROUP BY x")
def boosting_rates(t):
    """The first round fits the mean of labels -1 and 1; the margin is doubled in the logistic link."""
    return _rates(t, M.gbt_classifier(rounds=1, max_depth=1))


@query("boosting_means", _MEANS)
def boosting_means(t):
    return _means(t, M.gbt_regressor(rounds=1, max_depth=1, labelCol="price"))


@query("importance_of_one", f"SELECT 'x' AS feature, 1.0::DOUBLE AS importance FROM {_INDICATOR} LIMIT 1")
def importance_of_one(t):
    """A constant beside the only informative feature takes no part."""
    df = _indicator(t).withColumn("same", F.lit(1.0))
    df = M.VectorAssembler(inputCols=["same", "x"], outputCol="features").transform(df)
    return M.importance(M.tree_classifier(max_depth=3).fit(df), ["same", "x"])


@query(
    "kernel_svm_separable",
    "SELECT x, x AS prediction, count(*) AS n FROM (SELECT (c_nationkey >= 12)::INT::DOUBLE AS x FROM customer) GROUP BY x",
)
def kernel_svm_separable(t):
    """Two values, a class each."""
    df = t("customer").select((F.col("c_nationkey") >= 12).cast("double").alias("x")).withColumn("label", F.col("x"))
    scored = M.score(M.KernelSVM(["x"], "label", gamma=1.0).fit(df), df, ["x"])
    return scored.groupBy("x", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("model_reload", "SELECT count(*) AS rows, 0::BIGINT AS different FROM documents JOIN labels USING (doc_id)")
def model_reload(t):
    """A saved and reloaded model predicts the same."""
    df = _documents(t)
    fitted = Pipeline(stages=[_prepared(), M.tree_classifier(max_depth=5)]).fit(df)
    path = scratch_path(t.spark, "model")
    S.save_model(fitted, path)
    first = fitted.transform(df).select(*df.columns, F.col("prediction").alias("first"))
    again = S.load_model(path).transform(first)
    return again.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("first") != F.col("prediction")).alias("different"))


def _versions(label):
    return f"""votes AS (SELECT x, (avg({label}) > 0.5)::INT AS p FROM v WHERE c_custkey % 4 <> 0 GROUP BY x)
        SELECT 'stump' AS model, '{label}' AS dataset, 'accuracy' AS metric, round(avg(({label} = p)::INT), 6) AS value
        FROM v JOIN votes USING (x) WHERE c_custkey % 4 = 0"""


_MARKED = """v AS (SELECT c_custkey, (c_acctbal >= 2000)::INT AS x, (c_acctbal >= 2000)::INT AS clean,
    CASE WHEN c_nationkey < 5 THEN 1 - (c_acctbal >= 2000)::INT ELSE (c_acctbal >= 2000)::INT END AS original FROM customer)"""


@query(
    "label_versions",
    f"SELECT * FROM (WITH {_MARKED}, {_versions('original')}) UNION ALL SELECT * FROM (WITH {_MARKED}, {_versions('clean')})",
)
def label_versions(t):
    """One split, trained on labels with flips in some nations and on clean ones."""
    x = (F.col("c_acctbal") >= 2000).cast("double")
    df = _one(t("customer").select("c_custkey", "c_nationkey", x.alias("x")), "x")
    versions = {
        "original": df.withColumn("label", F.when(F.col("c_nationkey") < 5, 1 - F.col("x")).otherwise(F.col("x"))),
        "clean": df.withColumn("label", F.col("x")),
    }
    parts = {n: (d.where("c_custkey % 4 <> 0"), d.where("c_custkey % 4 = 0")) for n, d in versions.items()}
    out = M.compare_datasets({"stump": M.tree_classifier(max_depth=1)}, parts, lambda p: E.accuracy(p, "label", "prediction"))
    return C.round_cols(out, ["value"], 6)


# --- searches ---------------------------------------------------------------------------

FOLDS = 4
GRID = [100.0, 1000.0, 10_000.0, 100_000.0, 1_000_000.0]
DRAWS, SEED = 20, 7
RIDGE_RANGE, LASSO_RANGE = (1e2, 1e6), (1e1, 5e3)
_RIDGE = "covar_pop(x, y) * count(*) / (var_pop(x) * count(*) + a)"
_LASSO = "greatest(abs(covar_pop(x, y)) - a, 0) * sign(covar_pop(x, y)) / var_pop(x)"


def _drawn(low, high):
    rng = random.Random(SEED)
    return [H.log_uniform(low, high)(rng) for _ in range(DRAWS)]


def _fold_scores(name: str, slope: str, strengths: list[float]) -> str:
    """Scores ``name(candidate, mean, std)`` of one slope with the penalty ``a``, over folds ``d``."""
    listed = ", ".join(f"({i}, {a!r}::DOUBLE)" for i, a in enumerate(strengths))
    return f"""{name}_a AS (SELECT * FROM (VALUES {listed}) AS v(candidate, a)),
      {name}_fit AS (SELECT f.fold, candidate, {slope} AS b, avg(x) AS mx, avg(y) AS my
        FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold CROSS JOIN {name}_a GROUP BY f.fold, candidate, a),
      {name}_r2 AS (SELECT candidate, d.fold, 1 - sum((y - my - b * (x - mx))**2) / (var_pop(y) * count(*)) AS r2
        FROM d JOIN {name}_fit f ON d.fold = f.fold GROUP BY candidate, d.fold),
      {name} AS (SELECT candidate, avg(r2) AS mean, stddev_pop(r2) AS std FROM {name}_r2 GROUP BY candidate)"""


_FOLDED = f"""d AS (SELECT c_nationkey::DOUBLE AS x, c_acctbal + 200.0 * c_nationkey AS y,
    ntile({FOLDS}) OVER (ORDER BY md5(c_custkey::VARCHAR || '|42')) - 1 AS fold FROM customer)"""
_TABLE = """SELECT candidate::INT AS candidate, round(mean, 6) AS mean, round(std, 6) AS std,
    candidate = (SELECT candidate FROM {0} ORDER BY mean DESC, candidate LIMIT 1) AS best FROM {0}"""


def _folded(t):
    y = F.col("c_acctbal") + 200.0 * F.col("c_nationkey")
    df = t("customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("x"), y.alias("label"))
    return folds(_one(df, "x"), "c_custkey", FOLDS, 42).select("features", "label", "fold")


def _scores(result):
    return C.round_cols(result.table.select("candidate", "mean", "std", "best"), ["mean", "std"], 6)


@query(
    "cross_validation_r2",
    f"""WITH {_FOLDED}, {_fold_scores('ridge', _RIDGE, [1000.0])}, {_fold_scores('lasso', _LASSO, [500.0])}
        SELECT 'ridge' AS model, round(mean, 6) AS mean, round(std, 6) AS std FROM ridge
        UNION ALL SELECT 'lasso', round(mean, 6), round(std, 6) FROM lasso""",
)
def cross_validation_r2(t):
    models = {"ridge": M.Ridge(1000.0), "lasso": M.Lasso(500.0)}
    return C.round_cols(H.cross_val(models, _folded(t), "fold", FOLDS, H.scorer("r2")), ["mean", "std"], 6)


@query("grid_search_r2", f"WITH {_FOLDED}, {_fold_scores('ridge', _RIDGE, GRID)} {_TABLE.format('ridge')}")
def grid_search_r2(t):
    ridge = M.Ridge()
    return _scores(H.grid_search(ridge, {ridge.strength: GRID}, _folded(t), "fold", FOLDS, H.scorer("r2")))


def _random_search(t, estimator, reach):
    return H.random_search(estimator, {estimator.strength: H.log_uniform(*reach)}, DRAWS, SEED, _folded(t), "fold", FOLDS, H.scorer("r2"))


@query("random_search_r2", f"WITH {_FOLDED}, {_fold_scores('ridge', _RIDGE, _drawn(*RIDGE_RANGE))} {_TABLE.format('ridge')}")
def random_search_r2(t):
    return _scores(_random_search(t, M.Ridge(), RIDGE_RANGE))


@query(
    "best_of_two_r2",
    f"""WITH {_FOLDED}, {_fold_scores('ridge', _RIDGE, _drawn(*RIDGE_RANGE))}, {_fold_scores('lasso', _LASSO, _drawn(*LASSO_RANGE))}
        SELECT candidate::INT AS candidate, round(mean, 6) AS mean, round(std, 6) AS std, true AS best FROM
        (SELECT * FROM (SELECT *, 0 AS second FROM ridge UNION ALL SELECT *, 1 FROM lasso) ORDER BY mean DESC, second, candidate LIMIT 1)""",
)
def best_of_two_r2(t):
    best = H.select_best(_random_search(t, M.Ridge(), RIDGE_RANGE), _random_search(t, M.Lasso(), LASSO_RANGE))
    return _scores(best).where("best")
