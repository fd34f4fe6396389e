"""Classification and regression metrics over a ``(label, prediction)`` table.

Each metric is one aggregate (partial + final); the classification report
is built from the confusion counts ``groupBy(label, prediction)``, whose size is
bounded by classes squared: they are written once, in one scan of the predictions, and every
figure follows from them by conditional sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import write_once


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def mse(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    e = F.col(label).cast("double") - F.col(pred).cast("double")
    return df.agg(F.avg(e * e).alias("mse"))


def r2(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """1 - SSE/SST (SST about the mean of the labels)."""
    y = F.col(label).cast("double")
    e = y - F.col(pred).cast("double")
    return df.agg((F.lit(1.0) - F.sum(e * e) / (F.var_pop(y) * F.count(F.lit(1)))).alias("r2"))


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction"
                          ) -> DataFrame:
    """Per class precision, recall, F1 and support, then the rows ``accuracy``
    (f1 = accuracy, support = all rows), ``macro avg`` and ``weighted avg``.
    A zero denominator gives 0."""
    conf = write_once(confusion(df, label, pred), "confusion")
    # each count goes to its label's and its prediction's class: one aggregate, no join
    both = conf.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), "n", F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").cast(conf.schema["label"].dataType).alias("cls"), F.lit(0).cast("bigint").alias("n"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("predicted")))).alias("c")).select("c.*")
    per = both.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("n").alias("support"), F.sum("predicted").alias("predicted"))

    def ratio(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    per = per.select("cls", "support", ratio("tp", "predicted").alias("precision"),
                     ratio("tp", "support").alias("recall"), "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    classes = per.select(F.col("cls").cast("string").alias("class"), "precision", "recall",
                         "f1", F.col("support").cast("bigint").alias("support"))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                  F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("class"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        F.col("n").cast("bigint").alias("support"))
    n = F.col("n")
    summary = tot.select(F.explode(F.array(
        row("accuracy", F.lit(None), F.lit(None), F.col("tp") / n),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp") / n, F.col("wr") / n, F.col("wf") / n))).alias("r")
    ).select("r.*")
    return classes.unionByName(summary)


def mean_std(df: DataFrame, score: str = "score") -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return df.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))

