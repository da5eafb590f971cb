"""Sources, guard clauses, a small passenger workshop, and properties that hold for any data."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from calibra.functions.sizing import lookup_side, scratch_path
from calibra.operators import clusters, columns, describe, features, fills, metrics, models, outliers, quality, search, splits
from calibra.sources import tables as sources

PASSENGERS = "id int, survived int, class int, name string, age double, fare double, cabin string, port string"
ROWS = [
    (1, 0, 3, "  Ann   Bell ", 22.0, 7.25, None, "S"),
    (2, 1, 1, "Carl Dorn", 38.0, 71.28, "B58", "C"),
    (3, 1, 3, "Eva Fink", None, 7.92, "F G73", None),
    (4, 0, 1, "Gus Hart", 120.0, 53.1, "T", "S"),
    (5, 0, 4, "Ida Jung", 35.0, 8.05, "C12", "Q"),
    (6, 2, 3, "Kai Lang", 54.0, 8.46, None, "Q"),
    (7, 1, 2, "Mia Nord", 4.0, None, "E101", "S"),
    (8, 0, 3, "Ole Pohl", 20.0, 0.0, None, "S"),
    (2, 0, 1, "Carl Dorn", 39.0, 71.28, "B58", "C"),
    (9, 1, 2, "Una Voss", 14.0, 30.07, "D10", "C"),
    (10, 0, 2, "Wim Zahn", 31.0, 512.33, "A5", "C"),
]


@pytest.fixture(scope="module")
def passengers(spark):
    return spark.createDataFrame(ROWS, PASSENGERS)


def test_passenger_workshop(passengers):
    df = fills.fill_stat(passengers, ["age", "fare"], "median")
    df = fills.fill_const(df, {"cabin": "none", "port": "S"})
    assert not quality.null_total(df).first()["any_missing"]
    df = df.where("fare > 0").withColumn("name", columns.clean_text("name"))
    df = df.withColumn("deck", columns.prefix_class("cabin", "[A-Z][0-9]"))
    decks = {r["id"]: r["deck"] for r in df.select("id", "deck").collect()}
    assert decks[2] == "B" and decks[3] == "X" and decks[4] == "X" and decks[1] == "X" and decks[7] == "E"
    assert quality.dup_count(df, ["id"]).first()["duplicates"] == 1
    df = quality.dedupe(df, ["id"], ["age"])
    assert df.where("id = 2").first()["survived"] == 1
    df = columns.between(df, "age", 0, 100)
    df = columns.isin(columns.isin(df, "class", [1, 2, 3]), "survived", [0, 1])
    df = outliers.trim_quantile(df, "fare", 0.99)
    assert sorted(r["id"] for r in df.collect()) == [1, 2, 3, 7, 9]
    assert df.where("id = 1").first()["name"] == "Ann Bell"
    rates = describe.group_rate(df, ["class"], F.col("survived") == 1).orderBy("class").collect()
    assert [(r["class"], r["hits"], r["count"]) for r in rates] == [(1, 1, 1), (2, 2, 2), (3, 1, 2)]
    coded = features.one_hot(df, ["port"])
    assert coded.columns[-2:] == ["port_C", "port_S"]


def test_missing_path_fails_at_once(spark):
    with pytest.raises(AnalysisException):
        sources.load_table(spark, "/no/such/table.parquet")


def test_csv_keeps_missing_and_text(spark, passengers):
    path = scratch_path(spark, "passengers")
    sources.write_csv(passengers.select("id", "fare", "cabin", "name"), path)
    back = sources.read_csv(spark, path, "id int, fare double, cabin string, name string")
    _, size = sources.load_table(spark, path, "id int, fare double, cabin string, name string")
    assert size["rows"] == len(ROWS) and size["columns"] == 4
    assert back.where("cabin is null").count() == 3 and back.where("fare is null").count() == 1


def test_nan_becomes_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert quality.null_total(sources.nan_to_null(df)).first()["missing"] == 1


def test_reloaded_model_predicts_the_same(spark, tables):
    df = tables("lineitem").select("l_quantity", "l_tax", "l_returnflag", (F.col("l_discount") > 0.05).cast("double").alias("label"))
    prep = features.TablePreparer(num=["l_quantity", "l_tax"], cat=["l_returnflag"])
    fitted = Pipeline(stages=[prep, models.tree_classifier(max_depth=4)]).fit(df)
    path = scratch_path(spark, "tree")
    sources.save_model(fitted, path)
    a = models.score(fitted, df, ["label"], 2).groupBy("prediction", F.round("p1", 9)).count()
    b = models.score(sources.load_model(path), df, ["label"], 2).groupBy("prediction", F.round("p1", 9)).count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_preparer_handles_quotes_and_unseen(spark):
    train = spark.createDataFrame([("it's", 1.0), ("b\\c", 2.0), ("it's", None)], "t string, x double")
    prep = features.TablePreparer(num=["x"], cat=["t"], scale=False).learn(train)
    assert prep.names == ["x", "t"]
    new = spark.createDataFrame([("b\\c", None), ("zzz", 5.0), (None, 1.0)], "t string, x double")
    got = [list(r["features"]) for r in prep.model().transform(new).select("features").collect()]
    assert got == [[1.5, 0.0], [5.0, -1.0], [1.0, 1.0]]


def test_few_values_have_no_fences(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (900.0,), (None,)], "x double")
    assert outliers.iqr_bounds(df, ["x"]).count() == 0
    assert outliers.iqr_drop(df, ["x"]).count() == 4


def test_missing_is_no_outlier(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(500.0,), (None,)], "x double")
    assert outliers.iqr_drop(df, ["x"]).count() == 11
    assert [r["x"] for r in outliers.iqr_rows(df, "x").collect()] == [500.0]


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, 7.0, None), (2, 7.0, None)], "a int, b double, c string")
    assert columns.drop_constant(df).columns == ["a"]
    assert [r["b"] for r in features.minmax(df, ["b"]).collect()] == [0.0, 0.0]
    assert [r["b"] for r in features.standardize(df, ["b"]).collect()] == [0.0, 0.0]


def test_log_needs_all_rows_positive(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1.0), (2.0, 3.0, None)], "a double, b double, c double")
    row = features.log_positive(df, ["a", "b", "c"]).orderBy("b").first()
    assert row["a"] == 0.0 and row["b"] == 0.0 and row["c"] == 1.0


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b", 3.0), ("a", 1.0), ("a", 3.0), ("b", 1.0), ("c", 2.0)], "t string, x double")
    assert describe.modes(df, ["t"]).first()["top"] == "a"
    assert describe.modes(df, ["x"]).first()["top"] == 1.0


def test_label_and_binary_encoding_of_missing(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, t string")
    assert {r["id"]: r["t"] for r in features.label_encode(df, ["t"]).collect()} == {1: 0, 2: 1, 3: 2}
    bits = {r["id"]: (r["t_0"], r["t_1"]) for r in features.binary_encode(df, ["t"]).collect()}
    assert bits == {1: (0, 1), 2: (0, 0), 3: (1, 0)}


def test_too_many_indicator_levels_fail(spark):
    with pytest.raises(ValueError):
        features.one_hot(spark.range(50), ["id"], max_levels=10)


def test_results_do_not_depend_on_partitions(tables):
    orders = tables("orders")
    for op in (
        lambda d: describe.describe(d, ["o_totalprice"]),
        lambda d: describe.modes(d, ["o_orderpriority"]),
        lambda d: splits.folds(d.select("o_orderkey"), "o_orderkey", 3, 1),
        lambda d: describe.scatter_sample(d, ["o_totalprice"], 20, "o_orderkey"),
    ):
        one = sorted(map(str, op(orders.repartition(1)).collect()))
        seven = sorted(map(str, op(orders.repartition(7)).collect()))
        if "mean" not in op(orders).columns:
            assert one == seven
        else:
            a, b = op(orders.repartition(1)).first(), op(orders.repartition(7)).first()
            assert [a[c] for c in ("count", "min", "q25", "q50", "max")] == [b[c] for c in ("count", "min", "q25", "q50", "max")]


def test_rand_index_limits(spark):
    df = spark.range(60).select((F.col("id") % 3).alias("a"), (F.col("id") % 3 + 5).alias("b"), F.lit(1).alias("c"))
    assert metrics.ari(df, "a", "b").first()["ari"] == pytest.approx(1.0)
    assert metrics.ari(df, "a", "c").first()["ari"] == pytest.approx(0.0)


def test_confusion_lists_every_class(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, p string")
    table = {r["actual"]: (r["a"], r["b"]) for r in metrics.confusion(df, "y", "p").collect()}
    assert table == {"a": (1, 1), "b": (0, 0)}


def test_auc_limits(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.4), (1, 0.9)], "y int, s double")
    assert metrics.auc_by_class(df, "y", {1: F.col("s")}).first()["auc"] == pytest.approx(0.875)


def test_ridge_matches_the_closed_form(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 3))
    y = x @ [2.0, -1.0, 0.0] + 4 + rng.normal(size=80)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, label double")
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    xc, yc = x - x.mean(0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + 7.0 * np.eye(3), xc.T @ yc)
    model = models.Ridge(7.0).fit(data)
    assert model.coefficients.toArray() == pytest.approx(expected, rel=1e-6)
    lasso = models.Lasso(0.5).fit(data)
    # Optimality of the penalised solution: the residual correlations stay within alpha.
    slack = xc.T @ (yc - xc @ lasso.coefficients.toArray()) / len(y)
    assert abs(slack).max() <= 0.5 + 1e-4
    assert models.nonzero_count(models.coefficients(lasso, ["a", "b", "c"])).first()["nonzero"] == 2


def test_searches(spark, tables):
    df = tables("lineitem").select("l_quantity", "l_tax", "l_orderkey", "l_partkey", F.col("l_extendedprice").alias("label"))
    df = splits.folds(df, ["l_orderkey", "l_partkey"], 3, 1).persist()
    ridge = models.Ridge()
    pipe = Pipeline(stages=[features.TablePreparer(num=["l_quantity", "l_tax"]), ridge])
    grid = search.grid_search(pipe, {ridge.strength: [0.1, 1e6]}, df, "fold", 3, search.scorer("r2"))
    assert grid.params["strength"] == 0.1 and grid.table.count() == 2
    draws = search.random_search(pipe, {ridge.strength: search.log_uniform(1e-2, 1e2)}, 2, 5, df, "fold", 3, search.scorer("r2"))
    again = search.random_search(pipe, {ridge.strength: search.log_uniform(1e-2, 1e2)}, 2, 5, df, "fold", 3, search.scorer("r2"))
    assert draws.params == again.params
    assert search.select_best(grid, grid) is grid


def test_alignment_swaps_reversed_clusters(spark):
    got = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, cluster int")
    truth = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "id int, y int")
    assert {r["id"]: r["cluster"] for r in clusters.align(got, truth, "id", "y").collect()} == {1: 1, 2: 1, 3: 0}


def test_many_levels_have_codes_and_sparse_indicators(spark):
    rows = [(i, f"level {i % 1500:04}", None, None, float(i)) for i in range(3000)] + [(3000, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, c string, none string, empty double, x double")
    prep = features.TablePreparer(num=["x", "empty"], cat=["c", "none"], scale=False).learn(df)
    unseen = spark.createDataFrame([(1, "other", "text", 1.0, 1.0)], df.schema.names)
    got = {r["id"]: list(r["features"]) for r in prep.model().transform(df).select("id", "features").collect()}
    assert prep.names == ["x", "empty", "c", "none"]
    assert all(got[i] == [float(i), 0.0, float(i % 1500), -1.0] for i in range(3000))
    assert got[3000] == [1499.5, 0.0, 0.0, -1.0]
    assert list(prep.model().transform(unseen).first()["features"])[2:] == [-1.0, -1.0]
    for first in (False, True):
        out = features.one_hot_vector(df, ["c"], drop_first=first)
        vectors = {r["id"]: r["c_vec"] for r in out.collect()}
        assert vectors[3000].size == 1500 - first and vectors[3000].numNonzeros() == 0
        for i in range(3000):
            level = i % 1500 - first
            assert list(vectors[i].indices) == ([level] if level >= 0 else [])


def test_pca_leaves_rows_with_missing_values_out(spark):
    whole = [(i, float(i % 7), float(i * i % 11)) for i in range(60)]
    df = spark.createDataFrame([*whole, (60, None, 500.0), (61, 300.0, float("nan"))], "id int, a double, b double")
    want = {r["id"]: r["pc1"] for r in features.pca(spark.createDataFrame(whole, df.schema), ["a", "b"]).collect()}
    got = {r["id"]: r["pc1"] for r in features.pca(df, ["a", "b"]).collect()}
    assert got.pop(60) is None and got.pop(61) is None
    assert got == pytest.approx(want)


def test_lookup_side_counts_bytes(spark):
    df = spark.range(50).selectExpr("id", "repeat('x', 1000) AS t")
    assert lookup_side(df, max_bytes=10_000) is df
    assert lookup_side(df).count() == 50
