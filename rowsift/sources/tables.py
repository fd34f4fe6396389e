"""Parquet table scans (column pruning and filter pushdown are left to Catalyst)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def scan_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def prepared_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-selection input from the embedding table: dense ``vec_id`` is the
    row position, ``label`` the target, ``embedding`` the feature vector."""
    return scan_table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS row_id", "label", "embedding AS features")
