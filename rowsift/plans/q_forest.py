"""Random-forest queries (rows-only checks: Spark trees bin features, so
values are compared through invariants in the tests, not against SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forest, split
from ..operators.preprocess import preprocess
from ..operators.search import evolve
from ..operators.selection import ForestFitness, fitness_forest
from ..sources.tables import prepared_embeddings, scan_table
from .catalog import register
from .q_tabular import H_HOLD

# The reference's forest: 100 trees, unlimited depth (Spark caps depth at 30).
TREES = 100
DEPTH = 30


def _holdout(spark, d):
    emb = prepared_embeddings(spark, d)
    return split.holdout_split(emb, 0.2, 42).persist()


@register("rf_classifier")
def q_rf_classifier(spark, d):
    """Forest fitted on the 80% part of the embedding table; hold-out predictions."""
    data = _holdout(spark, d)
    fm = forest.fit_forest(data.where(~F.col("is_test")), num_trees=TREES, max_depth=DEPTH)
    return forest.predict(fm, data.where("is_test")).select("row_id", "label", "prediction")


@register("rf_regressor")
def q_rf_regressor(spark, d):
    """Regression forest (100 trees): order total price from the other
    standardised order columns (target given explicitly)."""
    o = scan_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                              "o_orderpriority", "o_orderstatus")
    prep = preprocess(o, target="o_totalprice", task="regression")
    t = prep.table.select(F.col("o_totalprice").alias("label"),
                          F.array(*[F.col(c) for c in prep.features]).alias("features"))
    fm = forest.fit_forest(t, task="regression", num_trees=TREES, max_depth=DEPTH)
    return forest.predict(fm, t).select("label", "prediction")


@register("rf_evaluate")
def q_rf_evaluate(spark, d):
    """Metric table of a forest: training time, accuracy and the per-class report."""
    data = _holdout(spark, d)
    fm = forest.fit_forest(data.where(~F.col("is_test")), num_trees=TREES, max_depth=DEPTH)
    table, _ = forest.evaluate(fm, data.where("is_test"))
    return table.where(F.col("metric") != "timestamp").where(F.col("metric") != "training_time")


@register("feature_importance")
def q_feature_importance(spark, d):
    """Importance of each standardised customer column for the market segment."""
    c = scan_table(spark, d, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", F.col("c_mktsegment").alias("class"))
    prep = preprocess(c)
    t = prep.table.select(F.col("class").alias("label"),
                          F.array(*[F.col(x) for x in prep.features]).alias("features"))
    fm = forest.fit_forest(t, num_trees=TREES, max_depth=DEPTH)
    return forest.feature_importance(fm, prep.features)


# What SQL can state about the forests' results: the exact hold-out, its labels and
# class supports, predictions among the known labels, importances that sum to one.
HELD = f"""
SELECT vec_id AS row_id, label FROM embeddings
QUALIFY row_number() OVER (ORDER BY {H_HOLD}, vec_id) <= ceil(CAST('0.2' AS DOUBLE) * (SELECT count(*) FROM embeddings))"""


@register("rf_classifier_checks", f"SELECT row_id, label, true AS known_class FROM ({HELD})")
def q_rf_classifier_checks(spark, d):
    """Hold-out rows with their labels, and whether each prediction is a class of the table."""
    classes = prepared_embeddings(spark, d).select(F.col("label").alias("prediction")).distinct()
    pred = q_rf_classifier(spark, d).withColumn("prediction", F.col("prediction").cast("int"))
    return (pred.join(classes.withColumn("known_class", F.lit(True)), "prediction", "left")
            .select("row_id", "label", F.coalesce("known_class", F.lit(False)).alias("known_class")))


@register("rf_evaluate_support", f"""
SELECT CAST(label AS VARCHAR) AS class, CAST(count(*) AS DOUBLE) AS support, true AS in_range
FROM ({HELD}) GROUP BY label""")
def q_rf_evaluate_support(spark, d):
    """Class supports of the evaluation, and whether the class's metrics lie in 0..1."""
    m = q_rf_evaluate(spark, d).where(F.col("class").rlike("^[0-9]+$"))
    scores = F.col("metric") != "support"
    return (m.groupBy("class").agg(
        F.max(F.when(~scores, F.col("value"))).alias("support"),
        F.bool_and(F.when(scores, F.col("value").between(0, 1)).otherwise(True)).alias("in_range"))
        .where("support > 0"))


@register("feature_importance_checks", """
SELECT 3 AS n_features, true AS sums_to_one, true AS none_negative""")
def q_feature_importance_checks(spark, d):
    """Number of features, and whether their importances are a distribution."""
    return q_feature_importance(spark, d).agg(
        F.count("*").cast("int").alias("n_features"),
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"),
        (F.min("importance") >= 0).alias("none_negative"))


@register("cross_validate_checks", "SELECT CAST(range AS INTEGER) AS fold, true AS in_range FROM range(5)")
def q_cross_validate_checks(spark, d):
    """The folds, and whether their accuracies lie in 0..1."""
    return q_cross_validate(spark, d).select("fold", F.col("score").between(0, 1).alias("in_range"))


@register("rf_evaluate_cv")
def q_rf_evaluate_cv(spark, d):
    """Evaluation with cross-validation of the same forest over the whole table."""
    data = _holdout(spark, d)
    fm = forest.fit_forest(data.where(~F.col("is_test")), num_trees=TREES, max_depth=DEPTH)
    table, _ = forest.evaluate(fm, data.where("is_test"), full=data.drop("is_test"))
    return table.where(~F.col("metric").isin("timestamp", "training_time"))


@register("cross_validate")
def q_cross_validate(spark, d):
    """5 stratified unshuffled folds of the embedding table, forest accuracy per fold."""
    emb = prepared_embeddings(spark, d)
    return forest.cross_validate(emb, num_trees=TREES, max_depth=DEPTH)


@register("fitness_rf")
def q_fitness_rf(spark, d):
    """Sequential-variant fitness of 20 seeded random subsets (forest on an
    80/20 hold-out of each subset)."""
    from ..functions.bits import random_masks
    pop = prepared_embeddings(spark, d).select("*", *random_masks(42, 20)).persist()
    f = fitness_forest(pop, list(range(20)), ForestFitness(num_trees=TREES, max_depth=DEPTH))
    return spark.createDataFrame(f, "solution int, n_selected bigint, accuracy double, "
                                    "fitness double")


# The reference's configuration of the sequential search.
SEQUENTIAL = dict(generations=50, population=20, parents=4, mutation_rate=0.10, seed=42, variant="sequential")


@register("evolve_sequential")
def q_evolve_sequential(spark, d):
    """Sequential variant (one elite, uniform crossover, random mutation, forest
    fitness), 50 generations of 20 solutions with 4 parents; rows of the final best."""
    res = evolve(prepared_embeddings(spark, d), fitness=ForestFitness(num_trees=TREES, max_depth=DEPTH), **SEQUENTIAL)
    return res.table.where(F.col("best") == 1).select("row_id", "label")
