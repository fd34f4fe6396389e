"""Spark session helpers.

The library never creates a cluster of its own: callers pass a session. These
helpers only fill in defaults that are missing (tests, bench, local runs) and
resolve the shared checkpoint folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rowsift") -> SparkSession:
    """Session for tests and local benchmarks (never used by the library)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("ROWSIFT_DRIVER_MEM", "16g")))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, from the session if it names one.

    A cluster sets ``spark.checkpoint.dir`` to a shared (distributed) folder;
    that setting always wins. Only when it is unset and the master is local
    (tests) a fresh scratch folder is created; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = _configured(spark)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="rowsift-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that outlives the application: the configured one, of which each application's
    checkpoint folder is a part; in tests, where none is configured, the scratch folder."""
    own = ensure_checkpoint_dir(spark)
    return _configured(spark) or own


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read
    it back: computed once, the same for every reader, safe from lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
