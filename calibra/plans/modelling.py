"""Queries over models, searches and their persistence."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.sizing import scratch_path
from ..operators import columns as C, features as X, metrics as E, models as M, search as H
from ..operators.splits import folds, split
from ..sources import tables as S
from .registry import query

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _lines(t):
    """Line items as a two-class problem: was the line returned?"""
    return t("lineitem").select(*_MEASURES, (F.col("l_returnflag") == "R").cast("double").alias("label"))


def _documents(t):
    """Labelled documents with numeric features of their whole texts."""
    text = F.col("text")
    words = F.size(F.split(F.trim(text), r"\s+")).cast("double")
    docs = t("documents").select(
        "doc_id",
        "lang",
        F.length(text).cast("double").alias("chars"),
        words.alias("words"),
        F.try_divide(F.length(text).cast("double"), words).alias("word_length"),
        (F.regexp_count(text, F.lit(r"[0-9]")) / F.greatest(F.length(text), F.lit(1))).alias("digit_share"),
        (F.regexp_count(text, F.lit("\n")) / words).alias("line_rate"),
    )
    labels = t("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return docs.join(labels, "doc_id")


_DOC_NUM = ["chars", "words", "word_length", "digit_share", "line_rate"]


def _prepared(num=_DOC_NUM, cat=("lang",)):
    return X.TablePreparer(num=num, cat=list(cat))


def _one(df, col):
    return VectorAssembler(inputCols=[col], outputCol="features").transform(df)


# --- persistence ------------------------------------------------------------------------


@query("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal FROM customer")
def csv_round_trip(t):
    df = t("customer").select("c_custkey", "c_name", "c_nationkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("c_acctbal"))
    path = scratch_path(t.spark, "customer-csv")
    S.write_csv(df, path)
    return S.read_csv(t.spark, path, df.schema)


@query("load_report", "SELECT count(*) AS rows, 6::BIGINT AS columns FROM part")
def load_report(t):
    _, size = S.load_table(t.spark, f"{t.directory}/part.parquet")
    return t.spark.createDataFrame([(size["rows"], size["columns"])], "rows bigint, columns bigint")


@query(
    "run_summary",
    """SELECT 'discount rule' AS model, round(avg((y = p)::INT), 6) AS accuracy,
         round(sum(y * p) / sum(p), 6) AS precision, round(sum(y * p) / sum(y), 6) AS recall, round(2 * sum(y * p) / (sum(p) + sum(y)), 6) AS f1
       FROM (SELECT (l_returnflag = 'R')::INT AS y, (l_discount >= 0.05)::INT AS p FROM lineitem)""",
)
def run_summary(t):
    df = t("lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_discount") >= 0.05).cast("int").alias("p"))
    one = E.prf_binary(df, "y", "p").withColumn("accuracy", E.accuracy(df, "y", "p").scalar()).withColumn("model", F.lit("discount rule"))
    path = scratch_path(t.spark, "run-summary")
    S.write_metrics(C.round_cols(one, ["accuracy", "precision", "recall", "f1"], 6), path)
    return t.spark.read.schema("model string, accuracy double, precision double, recall double, f1 double").json(path)


@query("model_round_trip")
def model_round_trip(t):
    df = _documents(t)
    fitted = Pipeline(stages=[_prepared(), M.Logistic(1.0)]).fit(df)
    path = scratch_path(t.spark, "model")
    S.save_model(fitted, path)
    return M.score(S.load_model(path), df, ["doc_id", "label"], 2)


# --- linear models with closed forms ----------------------------------------------------


@query(
    "ridge_one_feature",
    """SELECT round(b, 4) AS slope, round(my - b * mx, 2) AS intercept FROM (
         SELECT covar_pop(l_quantity, l_extendedprice) * count(*) / (var_pop(l_quantity) * count(*) + 50000) AS b,
                avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem)""",
)
def ridge_one_feature(t):
    df = _one(t("lineitem").select("l_quantity", F.col("l_extendedprice").alias("label")), "l_quantity")
    return _line(M.Ridge(50000.0).fit(df))


def _line(model):
    table = M.coefficients(model, ["slope"]).groupBy().pivot("term", ["slope", "intercept"]).agg(F.first("value"))
    return table.select(F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@query(
    "lasso_one_feature",
    """SELECT round(b, 4) AS slope, round(my - b * mx, 2) AS intercept FROM (
         SELECT greatest(abs(covar_pop(l_quantity, l_extendedprice)) - 5000, 0) * sign(covar_pop(l_quantity, l_extendedprice)) / var_pop(l_quantity) AS b,
                avg(l_quantity) AS mx, avg(l_extendedprice) AS my FROM lineitem)""",
)
def lasso_one_feature(t):
    df = _one(t("lineitem").select("l_quantity", F.col("l_extendedprice").alias("label")), "l_quantity")
    return _line(M.Lasso(5000.0).fit(df))


@query(
    "logistic_log_odds",
    """SELECT round(ln(p1 / (1 - p1)) - ln(p0 / (1 - p0)), 4) AS slope, round(ln(p0 / (1 - p0)), 4) AS intercept FROM (
         SELECT avg(y) FILTER (WHERE x = 1) AS p1, avg(y) FILTER (WHERE x = 0) AS p0
         FROM (SELECT (l_quantity >= 25)::INT AS x, (l_extendedprice >= 40000)::INT AS y FROM lineitem))""",
)
def logistic_log_odds(t):
    """With one indicator and no effective penalty the coefficients are log odds."""
    x = (F.col("l_quantity") >= 25).cast("double").alias("x")
    df = _one(t("lineitem").select(x, (F.col("l_extendedprice") >= 40000).cast("double").alias("label")), "x")
    table = M.coefficients(M.Logistic(1e9).fit(df), ["slope"]).groupBy().pivot("term", ["slope", "intercept"]).agg(F.first("value"))
    return C.round_cols(table, ["slope", "intercept"], 4)


@query(
    "tree_leaf_rates",
    """SELECT x, round(avg(y), 6) AS p1, count(*) AS n, (avg(y) > 0.5)::INT::DOUBLE AS prediction
       FROM (SELECT (l_quantity >= 25)::INT::DOUBLE AS x, (l_quantity * l_discount > 1.005)::INT AS y FROM lineitem) GROUP BY x""",
)
def tree_leaf_rates(t):
    """A tree of one split predicts the class rates of the two sides."""
    x = (F.col("l_quantity") >= 25).cast("double").alias("x")
    label = (F.col("l_quantity") * F.col("l_discount") > 1.005).cast("double").alias("label")
    df = _one(t("lineitem").select(x, label), "x")
    scored = M.score(M.tree_classifier(max_depth=1).fit(df), df, ["x"], 2)
    return scored.groupBy("x", F.round("p1", 6).alias("p1"), "prediction").agg(F.count(F.lit(1)).alias("n"))


# --- fitted models, scored --------------------------------------------------------------


def _fit_and_report(t, estimator, num=_MEASURES):
    """Stratified split, fit on the training part, class scores on both parts."""
    keyed = t("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_MEASURES, (F.col("l_extendedprice") > 30000).cast("double").alias("label")
    )
    parts = split(keyed, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], 0.2, 42, stratify="label").drop(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    ).persist()
    prep = X.TablePreparer(num=[c for c in num if c != "l_extendedprice"])
    fitted = Pipeline(stages=[prep, estimator]).fit(parts.where("part = 'train'"))
    return E.split_metrics(fitted.transform(parts), "label", "prediction")


@query("logistic_model")
def logistic_model(t):
    return _fit_and_report(t, M.Logistic(1.0))


@query("tree_model")
def tree_model(t):
    return _fit_and_report(t, M.tree_classifier(max_depth=5, min_leaf=5))


@query("forest_model")
def forest_model(t):
    return _fit_and_report(t, M.forest_classifier(trees=20, max_depth=5))


@query("boosting_model")
def boosting_model(t):
    return _fit_and_report(t, M.gbt_classifier(rounds=10, max_depth=3))


def _regression(t, estimator):
    df = t("lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    fitted = Pipeline(stages=[X.TablePreparer(num=["l_quantity", "l_discount", "l_tax"]), estimator]).fit(df)
    return E.regression_metrics(fitted.transform(df), "label", "prediction")


@query("forest_regression")
def forest_regression(t):
    return _regression(t, M.forest_regressor(trees=10, max_depth=5))


@query("boosting_regression")
def boosting_regression(t):
    return _regression(t, M.gbt_regressor(rounds=10, max_depth=3))


@query("kernel_svm")
def kernel_svm(t):
    df = _documents(t)
    scaled = X.standardize(df, _DOC_NUM)
    fitted = M.KernelSVM(_DOC_NUM, "label", width=50).fit(scaled)
    return M.score(fitted, scaled, ["doc_id", "label"], 2)


@query("feature_importance")
def feature_importance(t):
    df = _documents(t)
    prep = _prepared().learn(df)
    fitted = M.forest_classifier(trees=20, max_depth=5).fit(prep.model().transform(df))
    return M.importance(fitted, prep.names)


@query("model_coefficients")
def model_coefficients(t):
    df = _documents(t)
    prep = _prepared().learn(df)
    return M.coefficients(M.Logistic(1.0).fit(prep.model().transform(df)), prep.names)


@query("lasso_nonzero")
def lasso_nonzero(t):
    df = t("lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    prep = X.TablePreparer(num=["l_quantity", "l_discount", "l_tax"]).learn(df)
    return M.nonzero_count(M.coefficients(M.Lasso(100.0).fit(prep.model().transform(df)), prep.names))


# --- searches ---------------------------------------------------------------------------


def _folded(t, k=3):
    return folds(_documents(t), "doc_id", k, 42, stratify="label").persist()


@query("cross_validation")
def cross_validation(t):
    models = {
        "logistic": Pipeline(stages=[_prepared(), M.Logistic(1.0)]),
        "tree": Pipeline(stages=[_prepared(), M.tree_classifier(max_depth=4)]),
    }
    return H.cross_val(models, _folded(t), "fold", 3, H.scorer("accuracy"))


@query("grid_search")
def grid_search(t):
    tree = M.tree_classifier()
    grid = {tree.maxDepth: [2, 5], tree.minInstancesPerNode: [1, 5]}
    return H.grid_search(Pipeline(stages=[_prepared(), tree]), grid, _folded(t), "fold", 3, H.scorer("accuracy")).table


def _poly_search(t, estimator, seed):
    expand = PolynomialExpansion(inputCol="features", outputCol="terms")
    estimator = estimator.copy()
    estimator._set(featuresCol="terms", labelCol="word_length")
    df = folds(_documents(t), "doc_id", 3, 42).persist()
    pipe = Pipeline(stages=[X.TablePreparer(num=["chars", "digit_share", "line_rate"]), expand, estimator])
    draws = {estimator.strength: H.log_uniform(1e-3, 1e2), expand.degree: H.choice([2, 3])}
    return H.random_search(pipe, draws, 4, seed, df, "fold", 3, H.scorer("r2", "word_length"))


@query("random_search")
def random_search(t):
    return _poly_search(t, M.Ridge(), 7).table


@query("best_of_two_searches")
def best_of_two_searches(t):
    best = H.select_best(_poly_search(t, M.Ridge(), 7), _poly_search(t, M.Lasso(), 7))
    return best.table.where("best")


@query("label_version_comparison")
def label_version_comparison(t):
    """Train two models on the given labels and on labels corrected by the toxicity mark."""
    df = split(_documents(t), "doc_id", 0.25, 42, stratify="label")
    marks = t("labels").select("doc_id", "toxic")
    fixed = df.join(marks, "doc_id").withColumn("label", F.when(F.col("toxic") == 1, 0.0).otherwise(F.col("label"))).drop("toxic")
    models = {
        "tree": Pipeline(stages=[_prepared(), M.tree_classifier(max_depth=4)]),
        "logistic": Pipeline(stages=[_prepared(), M.Logistic(1.0)]),
    }
    versions = {n: (d.where("part = 'train'"), d.where("part = 'test'")) for n, d in (("original", df), ("clean", fixed))}

    def evaluate(predictions):
        return E.prf_weighted(predictions, "label", "prediction").withColumn(
            "accuracy", E.accuracy(predictions, "label", "prediction").scalar()
        )

    return M.compare_datasets(models, versions, evaluate)


@query(
    "polynomial_expansion",
    """SELECT s_suppkey, s_acctbal AS t0, s_acctbal * s_acctbal AS t1, s_nationkey::DOUBLE AS t2, s_acctbal * s_nationkey AS t3,
         (s_nationkey * s_nationkey)::DOUBLE AS t4 FROM supplier""",
)
def polynomial_expansion(t):
    """The vector form used inside searches; its term order differs from :func:`poly`."""
    df = VectorAssembler(inputCols=["s_acctbal", "s_nationkey"], outputCol="features").transform(t("supplier"))
    out = PolynomialExpansion(degree=2, inputCol="features", outputCol="terms").transform(df)
    terms = vector_to_array("terms")
    return out.select("s_suppkey", *[terms[i].alias(f"t{i}") for i in range(5)])
