"""Forest operators (invariants) and the CSV sink."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from rowsift.operators import forest, split
from rowsift.sources.delimited import write_reduced_csv
from rowsift.sources.tables import prepared_embeddings


def test_forest_fit_predict_evaluate(spark):
    emb = split.holdout_split(prepared_embeddings(spark, SF_SMALL), 0.2, 42).persist()
    train, test = emb.where(~F.col("is_test")), emb.where("is_test")
    fm = forest.fit_forest(train, num_trees=10, max_depth=5)
    assert fm.training_time > 0 and fm.timestamp is not None
    pred = forest.predict(fm, test)
    labels = {r.label for r in emb.select("label").distinct().collect()}
    assert {r.prediction for r in pred.select("prediction").distinct().collect()} <= labels
    assert pred.count() == test.count() == 100
    table, _ = forest.evaluate(fm, test)
    m = {(r.metric, r["class"]): r.value for r in table.collect()}
    assert 0 <= m[("accuracy", None)] <= 1 and m[("training_time", None)] > 0
    assert m[("support", "accuracy")] == 100
    imp = forest.feature_importance(fm, [f"f{i}" for i in range(64)]).collect()
    vals = [r.importance for r in imp]
    assert vals == sorted(vals, reverse=True) and abs(sum(vals) - 1) < 1e-6


def test_forest_regression_and_cv(spark):
    emb = prepared_embeddings(spark, SF_SMALL).withColumn("label", F.col("label").cast("double"))
    fm = forest.fit_forest(emb, task="regression", num_trees=5, max_depth=4)
    table, _ = forest.evaluate(fm, emb)
    m = {r.metric: r.value for r in table.collect()}
    assert m["mse"] >= 0 and m["r2"] <= 1
    cv = forest.cross_validate(prepared_embeddings(spark, SF_SMALL), num_trees=5, max_depth=4)
    rows = cv.collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4] and all(0 <= r.score <= 1 for r in rows)


def test_write_reduced_csv(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="rowsift-csv-"), "reduced")
    df = spark.createDataFrame([(1.5, 0, -0.2), (0.1, 1, 0.3)], "x double, class int, z double")
    write_reduced_csv(df, out, "class", ["x", "z"])
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["class", "x", "z"] and back.count() == 2


def test_forest_fitness_edge_cases(spark):
    from rowsift.functions.bits import pack_bits
    from rowsift.operators.selection import ForestFitness, fitness_forest
    emb = prepared_embeddings(spark, SF_SMALL)
    bits = [F.lit(0).cast("bigint"),                                  # empty selection
            (F.col("row_id") == 7).cast("bigint"),                    # one row: no train part
            (F.col("row_id") < 200).cast("bigint")]
    pop = emb.select("*", *pack_bits(bits)).persist()
    f = fitness_forest(pop, [0, 1, 2], ForestFitness(num_trees=5, max_depth=4)).set_index("solution")
    assert f.loc[0, "fitness"] == 0.0 and f.loc[0, "n_selected"] == 0
    assert f.loc[1, "fitness"] == 0.0 and f.loc[1, "n_selected"] == 1
    assert 0.0 < f.loc[2, "fitness"] <= 1.0 and f.loc[2, "n_selected"] == 200
    assert 0.0 <= f.loc[2, "accuracy"] <= 1.0


def test_patience_stops_early(spark):
    from rowsift.operators.search import evolve
    res = evolve(prepared_embeddings(spark, SF_SMALL), generations=30, population=4, parents=2,
                 seed=3, patience=2)
    h = res.history
    assert len(h) < 30 and h["stall"].iloc[-1] == 2
