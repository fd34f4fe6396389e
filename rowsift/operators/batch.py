"""Row selection over every dataset file of a folder.

Each file is its own chain of Spark jobs (scan -> preprocess -> search -> write). A bounded pool of
chains runs at the same time, each under its own fair-scheduler pool, so that small datasets
do not wait for large ones; a chain frees its own caches, also when it fails. A file
that fails is recorded in the error table and the batch goes on. Only
file paths (metadata) and per-dataset summary numbers reach the driver.
"""

from __future__ import annotations

import os
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.delimited import dataset_name, list_datasets, scan_delimited
from .preprocess import preprocess, to_model_table
from .search import select_instances

RESULT_SCHEMA = ("dataset string, path string, original_rows bigint, selected_rows bigint, "
                 "reduction_pct double, best_fitness double")
ERROR_SCHEMA = "dataset string, path string, error string"


def reduced_table(rows: DataFrame, target: str, features: list[str]) -> DataFrame:
    """Chosen rows as ``(target, feature...)`` (encoded target, standardised features)."""
    return rows.select(F.col("label").alias(target),
                       *[F.col("features")[i].alias(f) for i, f in enumerate(features)])


def _one_dataset(spark: SparkSession, path: str, out: str | None, target: str | None, raw: bool,
                 accept_single_column: bool, search_kw: dict) -> tuple:
    """One chain: its row of the result table."""
    name = dataset_name(path)
    model = res = None
    try:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        table = scan_delimited(spark, path, accept_single_column=accept_single_column)
        prep = preprocess(table, target=target, assign_row_id=True)
        model = to_model_table(prep).persist()
        rows, res = select_instances(model, **search_kw)
        n_sel = rows.count()
        if out:
            safe = re.sub(r"[^A-Za-z0-9_.-]", "__", name)
            chosen = (prep.clean.join(rows.select("row_id"), "row_id", "left_semi").drop("row_id") if raw
                      else reduced_table(rows, prep.target, prep.features))
            (chosen.write.mode("overwrite")
             .option("header", True).csv(os.path.join(out, f"dataset={safe}")))
        return (name, path, res.n_rows, n_sel, round((1 - n_sel / res.n_rows) * 100, 2), res.best_fitness)
    finally:
        if res is not None:
            res.release()
        if model is not None:
            model.unpersist()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def batch_datasets(spark: SparkSession, folder: str, out: str | None = None,
                   target: str | None = None, raw: bool = False, accept_single_column: bool = False,
                   at_once: int = 4, **search_kw) -> tuple[DataFrame, DataFrame]:
    """Run the search on every dataset under ``folder``, ``at_once`` of them at a time; write each reduced
    dataset to ``out/dataset=<parent>__<file>`` (CSV with header): encoded target and
    standardised features, or with ``raw`` the chosen rows as they were read."""
    paths = sorted(r["path"] for r in list_datasets(spark, folder).collect())

    def chain(path: str) -> tuple:
        try:
            return _one_dataset(spark, path, out, target, raw, accept_single_column, search_kw), None
        except Exception as e:  # a failing dataset is recorded, the batch goes on
            return None, (dataset_name(path), path, f"{type(e).__name__}: {e}"[:500])

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        done = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(chain), path) for path in paths]]
    return (spark.createDataFrame([r for r, _ in done if r], RESULT_SCHEMA),
            spark.createDataFrame([e for _, e in done if e], ERROR_SCHEMA))
