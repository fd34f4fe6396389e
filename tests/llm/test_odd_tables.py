"""Every query over empty tables and over tables with nulls, clashing names and repeated rows."""

import pytest

from conftest import SF_SMALL

from rowsift.llm import catalog

CLASH = ["row", "key", "id", "h", "w", "label", "score", "bucket", "split", "rank", "shard", "slot", "host", "canon", "item", "v", "n", "code"]


def write(spark, path, odd):
    from pyspark.sql import functions as F
    for name in ("documents", "labels", "pages", "benchmark", "embeddings"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if not odd:
            df = df.limit(0)
        else:
            part = df.limit(40)
            nulls = part.limit(3).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema))
            first = df.columns[0]
            no_id = part.limit(2).withColumn(first, F.lit(None).cast(df.schema[first].dataType))
            df = part.union(part.limit(5)).union(nulls).union(no_id)
            for c in CLASH:
                if c not in df.columns:
                    df = df.withColumn(c, F.lit("x"))
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    return {odd: write(spark, tmp_path_factory.mktemp("odd"), odd) for odd in (False, True)}


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_empty_tables(spark, folders, name):
    assert catalog.queries()[name](spark, folders[False]).count() == 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_nulls_repeats_and_clashing_names(spark, folders, name):
    rows = catalog.queries()[name](spark, folders[True]).collect()
    docs = spark.read.parquet(f"{folders[True]}/documents.parquet").count()
    if name.startswith(("op1_", "op2_", "op3_", "op4_", "op8_", "op9_", "op10_", "op13_")):
        assert len(rows) == docs
    elif name.startswith("op7_"):
        assert sum(r.piece == 0 for r in rows) == docs
    elif name.startswith("op6_"):
        assert len(rows) == spark.read.parquet(f"{folders[True]}/pages.parquet").count()
    elif name.startswith("op11_"):
        assert len(rows) == spark.read.parquet(f"{folders[True]}/embeddings.parquet").filter("embedding is not null").count()
    elif name == "pipeline":
        assert 0 < sum(r.piece == 0 for r in rows) < docs
