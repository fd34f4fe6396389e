"""Positions, ties, delimited files, typing and search extensions."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rowsift.operators import preprocess as pp
from rowsift.operators import search, selection, vectors
from rowsift.operators.ranks import scatter_by_position
from rowsift.operators.rowid import ordered_positions, with_row_id
from rowsift.sources import delimited


def test_row_ids_survive_a_cleared_cache(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    ids = with_row_id(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    n = li.count()
    assert ids.select("row_id").distinct().count() == n
    spark.catalog.clearCache()
    got = ids.agg(F.countDistinct("row_id").alias("d"), F.min("row_id"), F.max("row_id")).first()
    assert tuple(got) == (n, 0, n - 1)


def test_running_sums_and_empty_tables(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "k int, w int")
    rows = ordered_positions(df, ["k"], weight_col="w", out_col="s", num_partitions=4).orderBy("k").collect()
    total = 0
    for r in rows:
        assert r.s == total
        total += r.w
    assert ordered_positions(df.limit(0), ["k"]).count() == 0


def test_scatter_collision(spark):
    df = spark.createDataFrame([(0, 3), (1, 1), (2, 3), (3, 2), (4, 1)], "idx long, value long")
    assert [r.value for r in scatter_by_position(df, 5).orderBy("slot").collect()] == [1, 0, 2, 3, 0]


def test_zip_join_refuses_unequal_lengths(spark):
    a = spark.range(10).select(F.col("id").alias("idx"), F.col("id").alias("a"))
    b = spark.range(15).select(F.col("id").alias("idx"), F.col("id").alias("b"))
    with pytest.raises(Exception, match="differ in length"):
        vectors.zip_join([a, b], "idx").collect()
    assert vectors.zip_join([a, b.filter("idx < 10")], "idx").count() == 10


def test_best_is_the_first_index_of_the_maximum(spark, monkeypatch):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").selectExpr("vec_id AS row_id", "label", "embedding AS features")
    seen = []

    def fitness(rows, n_total):
        seen.append(rows.count())
        return 0.9 if len(seen) in (2, 3) else 0.1

    res = search.evolve(emb, generations=1, population=4, parents=2, fitness=fitness)
    best = res.table.where("best = 1").count()
    assert len(seen) == 4 and res.best_fitness == 0.9 and best == seen[1]


def test_quotes_dots_and_suffixes(spark, tmp_path):
    path = tmp_path / "a" / "quoted.csv"
    path.parent.mkdir()
    path.write_text('name,sepal.length,code,flag,Class\n"Smith, John",1.5,1d,true,0\n"O""Neil",2.5,2f,false,1\n'
                    '" x ",3.5,3d,true,0\n"two\nlines",4.5,4f,false,1\n')
    assert delimited.sniff_delimiter(spark, str(path))[0] == ","
    df = delimited.scan_delimited(spark, str(path))
    assert df.columns == ["name", "sepal.length", "code", "flag", "Class"]
    assert dict(df.dtypes)["code"] == "string" and dict(df.dtypes)["sepal.length"] == "double"
    assert {r.name for r in df.select("name").collect()} == {"Smith, John", 'O"Neil', " x ", "two\nlines"}
    prep = pp.preprocess(df, assign_row_id=True)
    assert prep.target == "Class" and "sepal.length" in prep.features
    assert pp.to_model_table(prep).count() == 4


def test_boolean_features_are_kept_and_scaled(spark):
    df = spark.createDataFrame([(1.0, True, 0), (2.0, False, 1), (3.0, True, 0), (4.0, False, 1)], "x double, b boolean, label int")
    prep = pp.preprocess(df)
    assert prep.features == ["x", "b"]
    assert sorted({r.b for r in prep.table.select("b").collect()}) == [-1.0, 1.0]


@pytest.mark.parametrize("n,kept", [(99, True), (100, False), (5000, False)])
def test_cardinality_is_exact_over_partitions(spark, n, kept):
    df = spark.range(6000).select(F.concat(F.lit("v"), F.col("id") % n).alias("c"), (F.col("id") % 2).alias("label")).repartition(7)
    vocab, card = pp.vocabulary(df, ["c"])
    assert ("c" in vocab) == kept and card["c"] == (n if kept else 100)
    if kept:
        assert vocab["c"] == sorted(f"v{i}" for i in range(n))


def test_checkpoint_folder_is_required_off_local_masters(spark):
    from rowsift.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_batch_writes_raw_rows_and_frees_its_caches(spark, tmp_path):
    from rowsift.operators.batch import batch_datasets
    folder = tmp_path / "in" / "d"
    folder.mkdir(parents=True)
    lines = ["name,x.y,Class"] + [f'"n, {i % 7}",{i % 13}.5,{i % 2}' for i in range(200)]
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    res, err = batch_datasets(spark, str(tmp_path / "in"), out=str(tmp_path / "out"), raw=True, generations=1,
                              population=4, parents=2)
    assert err.count() == 0 and res.count() == 1
    out = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out" / "dataset=d__a.csv"))
    assert out.columns == ["name", "x.y", "Class"] and out.count() == res.first().selected_rows
    assert {r.name for r in out.select("name").collect()} <= {f"n, {i}" for i in range(7)}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_ceiling_division_is_exact(spark):
    from rowsift.operators.partitions import ceil_div
    big = 2**60 + 1
    assert spark.range(1).select(ceil_div(F.lit(big), F.lit(2)).alias("c")).first().c == 2**59 + 1


def test_samples_are_fetched_in_groups_that_fit(spark):
    from rowsift.functions.bits import random_masks
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").selectExpr("vec_id AS row_id", "label", "embedding AS features")
    pop = emb.select("*", *random_masks(42, 6))
    whole = selection.fitness_knn(pop, list(range(6)), selection.KnnFitness(seed=42))
    small = selection.fitness_knn(pop, list(range(6)), selection.KnnFitness(seed=42, broadcast_budget=300_000))
    assert whole.equals(small)
