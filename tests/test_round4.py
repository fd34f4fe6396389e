"""Forests grown by groups, and neighbours ranked in float32."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsift.operators import forest, knn, trees


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, 4))
    y = (x[:, 0] > .5).astype(int) * 7 + (x[:, 2] > .4)
    return spark.createDataFrame([(i, int(a), v.tolist()) for i, (a, v) in enumerate(zip(y, x))],
                                 "row_id long, label int, features array<double>").persist()


@pytest.mark.parametrize("group_rows", [50, 1 << 16])
def test_groups_grow_whole_trees(table, group_rows):
    """Large nodes are split by histograms, small ones by tasks; both learn the classes, and trees are a table."""
    fm = forest.fit_forest(table, num_trees=8, group_rows=group_rows)
    assert (sum(len(t.feature) for t in fm.model.tops) > 8) == (group_rows == 50)
    assert fm.model.parts.count() == sum(f < 0 for t in fm.model.tops for f in t.feature)
    pred = forest.predict(fm, table)
    assert pred.count() == 600 and pred.where(F.col("prediction") == F.col("label")).count() > 590
    imp = dict(forest.feature_importance(fm, list("abcd")).collect())
    assert abs(sum(imp.values()) - 1) < 1e-9 and imp["a"] + imp["c"] > 0.8


def test_same_forest_however_rows_are_dealt(table):
    one, two = (forest.predict(forest.fit_forest(t, num_trees=5, max_depth=4), table) for t in (table.coalesce(1), table.repartition(7)))
    assert sorted(one.select("row_id", "prediction").collect()) == sorted(two.select("row_id", "prediction").collect())


def test_equal_rows_are_drawn_by_their_count():
    h = np.arange(40_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for copies in (1, 30, 5000):
        w = trees.bootstrap(h, np.full(len(h), copies), 2, 42)
        assert abs(w.mean() / copies - 1) < 0.03 and abs(w.var() / copies - 1) < 0.05


def test_regression_of_repeated_rows(spark):
    t = spark.createDataFrame([(float(i % 5) * 3 + 1000, [float(i % 5), 1.0]) for i in range(500)], "label double, features array<double>")
    fm = forest.fit_forest(t, task="regression", num_trees=3, group_rows=2)
    assert forest.predict(fm, t).where(F.abs(F.col("label") - F.col("prediction")) > 1e-6).count() == 0


@pytest.mark.parametrize("kind", ["normal", "far", "copies", "whole", "huge"])
def test_neighbours_are_exact(kind):
    rng = np.random.default_rng(1)
    xt, xq = rng.normal(size=(400, 6)), rng.normal(size=(50, 6))
    if kind == "far":
        xt, xq = xt + 1e5, xq + 1e5
    if kind == "copies":
        xt = np.repeat(xt[:8], 50, axis=0)
    if kind == "whole":
        xt, xq = np.rint(xt), np.rint(xq)
    if kind == "huge":
        xt, xq = xt * 1e25, xq * 1e25
    tid = rng.permutation(400)
    d = ((xq[:, None] - xt) ** 2).sum(axis=2)
    best = np.take_along_axis(d, knn.neighbours(xq, xt, tid, 5), axis=1)
    assert np.allclose(best, np.sort(d, axis=1)[:, :5])
    if kind in ("whole", "normal"):
        assert (knn.neighbours(xq, xt, tid, 5) == np.lexsort((np.broadcast_to(tid, d.shape), d), axis=1)[:, :5]).all()


def test_few_rows_get_few_tasks(spark, table):
    fm = forest.fit_forest(table, num_trees=8)
    assert fm.model.parts.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism
    assert forest._cell_tasks(spark, 300) == 1 and forest._cell_tasks(spark, 1 << 30) == 1 << 14


def test_forests_side_by_side_as_one_by_one(spark, monkeypatch):
    rows = spark.range(120).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("int").alias("label"),
                                   F.array(*[F.sin(F.col("id") * i).cast("float") for i in (1, 2, 3)]).alias("features"))
    many = forest.cross_validate(rows, num_trees=3).collect()
    monkeypatch.setattr(forest, "AT_ONCE", 1)
    assert many == forest.cross_validate(rows, num_trees=3).collect()
    assert [r["fold"] for r in many] == [0, 1, 2, 3, 4]
