"""Results that must not depend on the plan, on the number of entries, or on the kinds of columns."""

import math

import pytest
from pyspark.sql import functions as F

from calibra.functions import sizing
from calibra.functions.quantiles import quantiles
from calibra.operators import columns, describe, fills, labels, models, outliers, search
from calibra.sources.tables import load_parquet

SMALL, LARGE = 2_000_000, 10


@pytest.fixture(scope="module")
def holed(spark):
    """Three groups, one wholly missing in ``x``; ``z`` is missing everywhere; NaN and ties; one key is NULL."""
    rows = []
    for i in range(300):
        x = None if i % 3 == 0 else math.nan if i % 50 == 1 else float(i % 17)
        rows.append((i, None if i % 3 == 2 else i % 3, x, None, i % 5))
    return spark.createDataFrame(rows, "id int, g int, x double, z double, n int").repartition(4).cache()


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("by", [[], ["g"]])
def test_quantiles_have_the_same_rows_in_both_plans(holed, by):
    probs = [0.0, 0.25, 0.5, 1.0]
    small, large = (quantiles(holed, ["x", "z", "n"], probs, by, task_rows=t) for t in (SMALL, LARGE))
    assert table(small) == table(large)
    assert small.count() == 3 * (3 if by else 1)
    assert {r["q"] is None for r in small.where("column = 'z'").collect()} == {True}


@pytest.mark.parametrize("after", [True, False])
def test_group_fill_leaves_nothing_missing_in_either_plan(holed, after):
    small, large = (fills.fill_group(holed, ["g"], ["x"], after, task_rows=t).select("id", "x") for t in (SMALL, LARGE))
    assert small.where("x is null or isnan(x)").count() == 0
    assert table(small) == table(large)


@pytest.mark.parametrize(
    "call",
    [
        lambda d, t: describe.describe(d, ["x", "z", "n"], t),
        lambda d, t: describe.central(d, ["x", "z", "n"], t),
        lambda d, t: describe.box_stats(d, ["g"], "x", t).drop("outliers"),
        lambda d, t: fills.fill_stat(d, ["x"], "median", t).select("id", "x"),
        lambda d, t: outliers.iqr_report(d, ["x", "n"], t),
        lambda d, t: outliers.iqr_drop(d, ["x"], task_rows=t).select("id"),
        lambda d, t: describe.quantile_class(d, "n", [0.33, 0.66], ["a", "b", "c"], "k", t).select("id", "k"),
    ],
)
def test_callers_of_quantiles_agree(holed, call):
    clean = holed.withColumn("x", F.nanvl("x", F.lit(None).cast("double")))
    assert table(call(clean, SMALL)) == table(call(clean, LARGE))


def test_box_of_a_missing_group_is_there(holed):
    for t in (SMALL, LARGE):
        assert describe.box_stats(holed, ["g"], "x", t).count() == 3


def test_central_keeps_missing_columns(holed):
    assert {r["column"] for r in describe.central(holed, ["x", "z"]).collect()} == {"x", "z"}


def test_modes_of_large_whole_numbers(spark):
    big = 2**53
    df = spark.createDataFrame([(big,), (big + 1,), (big + 1,), (big + 2,), (big + 3,)], "k bigint")
    assert tuple(describe.modes(df, ["k"]).first()) == ("k", big + 1, 2, 4)
    filled = fills.fill_stat(df.union(spark.createDataFrame([(None,)], "k bigint")), ["k"], "mode")
    assert sorted(r["k"] for r in filled.collect())[1:4] == [big + 1] * 3


@pytest.mark.parametrize("values", [list(range(300)), [i / 2 for i in range(300)], ["a", "b"] * 150, [True, False] * 150, [2**40] * 300])
def test_mapped_type_does_not_depend_on_the_size(spark, values):
    df = spark.createDataFrame([(i,) for i in range(0, 400, 7)], "k int")
    few = columns.map_values(df, "k", dict(enumerate(values[:200])), "v")
    many = columns.map_values(df, "k", dict(enumerate(values)), "v")
    assert few.schema["v"].dataType == many.schema["v"].dataType
    assert {r["k"]: r["v"] for r in many.collect()} == {i: values[i] if i < 300 else None for i in range(0, 400, 7)}


def test_nan_is_missing(spark):
    df = spark.createDataFrame([("1.5",), ("nan",), ("x",)], "t string")
    assert [r["t"] for r in columns.to_numeric(df, ["t"]).collect()] == [1.5, None, None]
    path = sizing.scratch_path(spark, "nan")
    spark.createDataFrame([(1.0, 1), (math.nan, 2)], "x double, k int").write.parquet(f"{path}/t.parquet")
    assert load_parquet(spark, path, "t").where("x is null").count() == 1


def test_tables_without_numbers_or_without_text(spark):
    text = spark.createDataFrame([("a", "b"), ("a", None)], "s string, t string")
    assert {r["column"]: r["top"] for r in describe.describe_all(text).collect()} == {"s": "a", "t": "b"}
    assert {r["section"] for r in describe.profile(text).collect()} == {"shape", "missing", "distinct"}
    one = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, s string")
    assert "correlation" not in {r["section"] for r in describe.profile(one).collect()}
    assert describe.profile(one.select("x")).count() > 0


def test_relabel_summary_takes_the_cap(spark):
    df = spark.createDataFrame([("a", "b", True)] * 10, "y string, predicted string, relabeled boolean")
    assert labels.relabel_summary(df, "y", cap=0.5).first()["max_relabel"] == 5
    assert labels.relabel_summary(df, "y").first()["max_relabel"] == 3


def test_binary_f1(spark):
    df = spark.createDataFrame([(1.0, 1.0)] + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 26, "label double, prediction double")
    assert search.scorer("f1_binary").evaluate(df) == pytest.approx(0.5)
    assert search.scorer("f1").evaluate(df) > 0.9


def test_kernel_machine_can_be_searched(spark):
    rows = [(math.cos(i) * r, math.sin(i) * r, float(r > 1.5), i % 3) for i in range(60) for r in (1.0, 2.0)]
    df = spark.createDataFrame(rows, "x double, y double, label double, fold int")
    svm = models.KernelSVM(["x", "y"], "label", width=40)
    assert {p.name for p in svm.params} >= {"C", "gamma", "width", "seed"}
    copied = svm.copy({svm.C: 3.0})
    assert copied.getOrDefault(copied.C) == 3.0 and svm.getOrDefault(svm.C) == 1.0
    found = search.grid_search(svm, {svm.gamma: [1e-6, 1.0]}, df, "fold", 3, search.scorer("accuracy"))
    assert found.params["gamma"] == 1.0 and found.score > 0.9


def test_no_own_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sizing.checkpoint_folder(Session())
