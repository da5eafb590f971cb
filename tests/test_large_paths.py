"""The plans for large tables must give the results of the plans for small ones."""

import math

import pytest
from pyspark.sql import functions as F

from calibra.functions import sizing
from calibra.functions.ordering import range_bounds, segmented, with_position, with_running_total
from calibra.functions.quantiles import _by_brackets, quantiles
from calibra.functions.sizing import join_null_safe, lookup_side
from calibra.operators import fills, metrics, splits


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thousand rows; a third belongs to one unit, a third shares one value and one moment."""
    base = spark.range(2000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("unit"),
        F.when(F.col("id") % 3 == 1, 7).otherwise(F.hash("id") % 1000).alias("at"),
        F.when(F.col("id") % 3 == 2, 5.0).otherwise((F.xxhash64("id") % 10000) / 7.0).alias("x"),
    )
    return base.withColumn("y", F.when(F.xxhash64("id", F.lit(1)) % 4 != 0, F.col("x"))).repartition(5, "unit")


@pytest.mark.parametrize("by", [[], ["unit"]])
def test_bracketed_quantiles_equal_one_aggregate(skewed, by):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]
    small = quantiles(skewed, ["x", "y"], probs, by)
    large = _by_brackets(skewed, ["x", "y"], probs, by)
    a = {tuple(r[:-1]): r["q"] for r in small.collect()}
    b = {tuple(r[:-1]): r["q"] for r in large.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == pytest.approx(a[k], rel=1e-12)


def test_quantile_path_follows_the_size(skewed):
    exact = quantiles(skewed, ["x"], [0.5], task_rows=100).first()["q"][0]
    assert exact == pytest.approx(quantiles(skewed, ["x"], [0.5]).first()["q"][0], rel=1e-12)


def test_segments_split_hot_moments(skewed):
    bounds = range_bounds(skewed, ["at", "id"], 20, 2000)
    assert len(bounds) > 10
    sizes = [r["count"] for r in segmented(skewed, ["at", "id"], 100).groupBy("__seg").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 500


@pytest.mark.parametrize("by", [[], ["unit"]])
@pytest.mark.parametrize("fill", [fills.ffill, fills.bfill, fills.interpolate])
def test_ordered_fills(skewed, fill, by):
    small = {r["id"]: r["y"] for r in fill(skewed, "y", ["at", "id"], by).collect()}
    large = {r["id"]: r["y"] for r in fill(skewed, "y", ["at", "id"], by, task_rows=150).collect()}
    assert small.keys() == large.keys()
    for k, v in small.items():
        assert large[k] == (v if v is None else pytest.approx(v, rel=1e-12))


@pytest.mark.parametrize("fill,limit", [("ffill", 1), ("bfill", 1), ("interpolate", 1)])
def test_ordered_fills_against_pandas(skewed, fill, limit):
    pdf = skewed.toPandas().sort_values(["at", "id"])
    expected = getattr(pdf.set_index("id")["y"], fill)()
    got = getattr(fills, fill)(skewed, "y", ["at", "id"], task_rows=300).toPandas().set_index("id")["y"]
    both = got.loc[expected.index]
    assert (both.isna() == expected.isna()).all()
    assert (both.dropna() - expected.dropna()).abs().max() < 1e-9


@pytest.mark.parametrize("by", [[], ["unit"]])
def test_positions_and_running_totals(skewed, by):
    small = rows(with_position(skewed, ["at", "id"], by).select("id", "position"))
    assert rows(with_position(skewed, ["at", "id"], by, task_rows=130).select("id", "position")) == small
    ints = skewed.withColumn("v", F.col("id") % 5)
    a = rows(with_running_total(ints, {"t": "v"}, ["at", "id"], by).select("id", "t"))
    assert rows(with_running_total(ints, {"t": "v"}, ["at", "id"], by, task_rows=130).select("id", "t")) == a


@pytest.mark.parametrize("stratify", [None, "unit"])
def test_splits_by_ticket_prefix(skewed, stratify):
    small = rows(splits.split(skewed, "id", 0.2, 1, stratify).select("id", "part"))
    assert rows(splits.split(skewed, "id", 0.2, 1, stratify, task_rows=50).select("id", "part")) == small
    small = rows(splits.folds(skewed, "id", 4, 1, stratify).select("id", "fold"))
    assert rows(splits.folds(skewed, "id", 4, 1, stratify, task_rows=50).select("id", "fold")) == small


def test_split_and_fold_sizes(skewed):
    n = skewed.count()
    test = splits.split(skewed, "id", 0.2, 3).where("part = 'test'").count()
    assert test == math.ceil(n * 0.2)
    sizes = [r["count"] for r in splits.folds(skewed, "id", 7, 3).groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == n


def test_split_ignores_partitioning(skewed):
    first = rows(splits.split(skewed.repartition(1), "id", 0.3, 9).select("id", "part"))
    assert rows(splits.split(skewed.repartition(7), "id", 0.3, 9).select("id", "part")) == first


def test_auc_in_segments(skewed):
    df = skewed.withColumn("label", F.when(F.col("x") + F.col("at") > 900, "p").otherwise("q"))
    scores = {"p": F.col("x"), "q": -F.col("at")}
    small = {r["class"]: r["auc"] for r in metrics.auc_by_class(df, "label", scores).collect()}
    large = {r["class"]: r["auc"] for r in metrics.auc_by_class(df, "label", scores, task_rows=90).collect()}
    assert large == pytest.approx(small, rel=1e-12)


def test_group_fill_with_many_groups(skewed, monkeypatch):
    small = rows(fills.fill_group(skewed, ["unit"], ["y"]).select("id", "y"))
    monkeypatch.setattr(fills, "lookup_side", lambda df: lookup_side(df, 3))
    assert rows(fills.fill_group(skewed, ["unit"], ["y"]).select("id", "y")) == small


def test_group_fill_falls_back_only_when_a_whole_group_is_missing(skewed):
    gap = skewed.withColumn("y", F.when(F.col("unit") != 7, F.col("y")))
    filled = fills.fill_group(gap, ["unit"], ["y"])
    expected = quantiles(fills.fill_group(gap.where("unit <> 7"), ["unit"], ["y"]), ["y"], [0.5]).first()["q"][0]
    assert filled.where("y is null").count() == 0
    assert {r["y"] for r in filled.where("unit = 7").collect()} == {expected}
    before = fills.fill_group(gap, ["unit"], ["y"], fallback_after=False)
    expected = quantiles(gap, ["y"], [0.5]).first()["q"][0]
    assert {r["y"] for r in before.where("unit = 7").collect()} == {expected}


def test_lookup_side_is_only_broadcast_when_small(spark, skewed):
    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "broadcast" in plan(skewed.join(lookup_side(spark.range(10), 10), "id"))
    assert "broadcast" not in plan(skewed.join(lookup_side(spark.range(11), 10), "id"))


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert sorted(r["w"] for r in join_null_safe(a, b, ["k"]).collect()) == [10, 20]


def test_checkpoint_folder_is_the_sessions(spark):
    folder = sizing.checkpoint_folder(spark)
    assert sizing.scratch_path(spark, "x").startswith(folder)
    assert sizing.cut_lineage(spark.range(3)).count() == 3
