"""Uniform mutation, targets of any number of classes, the search's log and storage."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rowsift.functions.bits import keyed_hash, keyed_hashes, pack_bits, random_masks, sql_keyed_hash
from rowsift.operators import classes, search, selection, split
from rowsift.operators.forest import fit_forest
from rowsift.operators.population import Mutation, mutation_cutoffs
from rowsift.sources.tables import prepared_embeddings


def flips(spark, mu, n):
    """Which of the rows 0..n-1 a mutation flips, by its cut-off."""
    cut, last = mutation_cutoffs(spark, n, [mu])[mu]
    ids = np.arange(n)
    h = keyed_hashes(ids, *mu.keys())
    return (h < cut) | ((h == cut) & (ids <= last))


def test_the_keyed_hash_is_the_same_in_spark_duckdb_and_numpy(spark):
    ids = [0, 1, 2, 999, 2**31, 2**32 - 1, 2**32, 2**45 + 17, 2**62 + 5]
    key = (123_456_789, 2**31 - 1)
    want = keyed_hashes(np.array(ids), *key).tolist()
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert [r.h for r in df.select("id", F.expr(keyed_hash("id", *key)).alias("h")).collect()] == want
    con = duckdb.connect()
    assert [con.execute(f"SELECT {sql_keyed_hash(str(i), *key)}").fetchone()[0] for i in ids] == want
    h = keyed_hashes(np.arange(300_000), 5, 6)
    assert len(np.unique(h)) == len(h) and 0 <= h.min() and h.max() < 1 << 32


@pytest.mark.parametrize("u", [0.0, 0.167, 0.5, 0.51, 0.999])
def test_flips_are_exact_and_uniform(spark, u):
    n, m = 1_000_000, 100_000
    f = flips(spark, Mutation(u, 0.4, rate=0.1), n)
    assert f.sum() == m
    deciles = f.reshape(10, -1).sum(axis=1)
    assert (abs(deciles - m / 10) < 6 * np.sqrt(m / 10)).all()
    for period in (2, 3, 4, 10):                     # labels in turn: every class gets its share
        got = np.bincount(np.arange(n) % period, f)
        assert (abs(got - m / period) < 6 * np.sqrt(m / period)).all()
    gaps = np.diff(np.flatnonzero(f))
    assert len(np.unique(gaps)) > 60 and abs((gaps == 1).mean() - 0.1) < 0.01 and abs((gaps == 2).mean() - 0.09) < 0.01


def test_flips_of_two_children_are_independent(spark):
    n = 1_000_000
    a, b = (flips(spark, Mutation(u, 0.4, rate=0.1), n) for u in (0.25, 0.25 + 2**-20))
    assert abs((a & b).sum() - n / 100) < 6 * np.sqrt(n / 100)


@pytest.mark.parametrize("n", [3, 20, 997, 30_000])
def test_cutoffs_equal_a_sort(spark, n):
    for mu in (Mutation(0.3, 0.9, percent=10.0), Mutation(0.7, 0.1, percent=99.9), Mutation(0.7, 0.2, percent=100.0)):
        h = keyed_hashes(np.arange(n), *mu.keys())
        want = set(np.lexsort((np.arange(n), h))[:mu.count(n)].tolist())
        assert set(np.flatnonzero(flips(spark, mu, n)).tolist()) == want


def test_a_window_that_misses_the_cut_off_is_widened(spark, monkeypatch):
    from rowsift.operators import population
    monkeypatch.setattr(population, "FETCH", 3)
    real = population._counted
    seen = []

    def first_empty(spark, n, todo):
        out = real(spark, n, todo)
        seen.append(todo)
        return {i: x * 0 for i, x in out.items()} if len(seen) == 1 else out

    monkeypatch.setattr(population, "_counted", first_empty)
    mu = Mutation(0.6, 0.6, rate=0.1)
    assert flips(spark, mu, 5000).sum() == 500 and seen[1][0][2:] == (0, 1 << 32) and len(seen) > 2


# ---------------------------------------------------------------- classes

MANY = "SELECT id AS row_id, CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE (id * 7919) % 11999 + 1 END AS INT) AS label FROM {}"


def sql_split(t, n):
    h = "CAST(('0x' || substr(md5('42:split:' || CAST(row_id AS VARCHAR)), 1, 15)) AS BIGINT)"
    return f"""
WITH t AS ({MANY.format(f'(SELECT range AS id FROM range({n}))')}),
c AS (SELECT label, count(*) AS c, ({t} * count(*)) // {n} AS base, ({t} * count(*)) % {n} AS rest FROM t GROUP BY label),
a AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= {t} - sum(base) OVER () THEN 1 ELSE 0 END AS a FROM c)
SELECT row_id, row_number() OVER (PARTITION BY label ORDER BY {h}, row_id) AS r, a FROM t JOIN a USING (label)"""


@pytest.mark.parametrize("broadcast_classes", [classes.BROADCAST_CLASSES, 100])
def test_twelve_thousand_classes(spark, monkeypatch, broadcast_classes):
    monkeypatch.setattr(classes.join_classes, "__defaults__", ("label", broadcast_classes))
    n, t = 200_000, 60_000
    df = spark.sql(MANY.format(f"range({n})"))
    assert df.select("label").distinct().count() == 12_000
    want = duckdb.connect().execute(sql_split(t, n)).fetchall()
    got = {r.row_id for r in split.stratified_split(df, t).where("in_train").select("row_id").collect()}
    assert got == {i for i, r, a in want if r <= a} and len(got) == t
    ranks = {r.row_id: r.class_rank for r in split.stratified_rank(df).select("row_id", "class_rank").collect()}
    assert ranks == {i: r for i, r, _ in want}
    folds = split.stratified_folds(df).groupBy("label", "fold").count().groupBy("label").agg(
        F.max("count") - F.min("count"), F.count("*")).collect()
    assert len(folds) == 12_000


def test_fitness_with_more_classes_than_sample_rows(spark):
    """Solution 0 keeps 12,000 classes (its sample is not stratified), solution 1 two, solution 2 three hundred."""
    df = spark.sql(MANY.format("range(60000)")).withColumn("features", F.array(F.col("label").cast("double"), (F.col("row_id") % 7).cast("double")))
    pop = df.select("*", *pack_bits([F.lit(1).cast("bigint"), F.col("label").isin([0, 5]).cast("bigint"),
                                     (F.col("label") < 300).cast("bigint")])).persist()
    stats = selection.population_stats(pop, [0, 1, 2])
    assert stats.solutions[0].n_classes == 12_000 and stats.solutions[0].classes is None
    assert stats.solutions[1].classes.keys() == {0, 5} and stats.solutions[2].n_classes == 300
    plans = selection.plan_knn_training(stats.solutions, selection.KnnFitness())
    assert [plans[s].stratified for s in range(3)] == [False, stats.solutions[1].smallest > 1, True]
    sample = selection.collect_knn_sample(pop, plans, stats.solutions, selection.KnnFitness())
    rows = {r.row_id: r for r in pop.select("row_id", "label", selection._hash_col(pop, "no", 42, "split").alias("h")).collect()}
    for s, keeps in ((0, lambda x: True), (2, lambda x: x.label < 300)):
        mine = sorted((r.h, r.row_id, r.label) for r in rows.values() if keeps(r))
        if s == 0:
            want = {i for _, i, _ in mine[:1000]}
        else:
            left, want = dict(plans[s].alloc), set()
            for _, i, lab in mine:
                if left.get(lab, 0) > 0:
                    left[lab] -= 1
                    want.add(i)
        assert set(sample.ids[s].tolist()) == want
    f = selection.fitness_knn(pop, [0, 1, 2]).set_index("solution")
    assert f.loc[1, "accuracy"] > 0.9 and 0 < f.loc[0, "fitness"] < 1 and f.loc[2, "accuracy"] > 0.6
    pop.unpersist()


def test_a_group_short_of_rows_is_asked_again(spark, monkeypatch):
    real = selection._limit
    monkeypatch.setattr(selection, "_limit", lambda k, n, slack: real(k, n, slack) // (50 if slack == 1.0 else 1))
    pop = prepared_embeddings(spark, SF_SMALL).select("*", *random_masks(1, 3))
    short = selection.fitness_knn(pop, [0, 1, 2])
    monkeypatch.undo()
    assert short.equals(selection.fitness_knn(pop, [0, 1, 2]))


def test_only_fractional_targets_are_refused(spark):
    df = spark.range(60).selectExpr("id row_id", "double(id % 2) label", "array(double(id)) features")
    assert split.stratified_split(df).where("in_train").count() == 45
    bad = df.withColumn("label", F.col("label") + 0.5)
    for call in (lambda: split.stratified_split(bad), lambda: split.stratified_rank(bad), lambda: search.evolve(bad),
                 lambda: fit_forest(bad), lambda: selection.fitness_knn(bad.select("*", *random_masks(1, 2)), [0])):
        with pytest.raises(classes.ContinuousTarget):
            call()


# ---------------------------------------------------------------- log and storage

SETTINGS = dict(generations=7, population=6, parents=2, seed=5, checkpoint_every=2)


def chosen(res):
    rows = sorted(r.row_id for r in res.table.where("best = 1").collect())
    res.release()
    return rows


@pytest.mark.parametrize("variant", ["parallel", "sequential"])
def test_a_search_resumes_from_its_log(spark, tmp_path, variant, monkeypatch):
    emb = prepared_embeddings(spark, SF_SMALL)
    kw = SETTINGS | dict(variant=variant, fitness=selection.KnnFitness(seed=5))
    whole = search.evolve(emb, **kw)

    class Lost(Exception):
        pass

    def lose(rec):
        if rec["generation"] == 5:
            raise Lost

    path = str(tmp_path / "log")
    with pytest.raises(Lost):
        search.evolve(emb, log=path, on_generation=lose, **kw)
    assert search.read_log(spark, path).agg(F.max("generation")).first()[0] == 3
    calls = []
    real = search.fitness_knn
    monkeypatch.setattr(search, "fitness_knn", lambda *a, **k: calls.append(1) or real(*a, **k))
    again = search.evolve(emb, log=path, **kw)
    assert len(calls) == len(whole.history) - 4                 # generations 0 to 3 were not evaluated again
    assert again.fitness.equals(whole.fitness) and again.history.equals(whole.history)
    assert chosen(again) == chosen(whole)
    calls.clear()
    assert chosen(search.evolve(emb, log=path, **kw)) == chosen(search.evolve(emb, log=path, **kw)) and not calls


def test_results_read_from_the_log(spark):
    emb = prepared_embeddings(spark, SF_SMALL)
    log = search.search_log(emb, **SETTINGS)
    res = search.evolve(emb, **SETTINGS)
    got = [tuple(r) for r in search.fitness_history(log).orderBy("generation").collect()]
    assert got == [tuple(x) for x in res.history.itertuples(index=False)]
    f = res.fitness[res.fitness.fitness == res.best_fitness].iloc[0]
    assert tuple(search.track_best(log).first()) == (f.generation, f.solution, f.fitness)
    assert log.count() == 42 and search.log_folder(emb, **SETTINGS) != search.log_folder(emb.limit(400), **SETTINGS)
    res.release()


def test_features_and_masks_meet_without_a_shuffle(spark):
    emb = prepared_embeddings(spark, SF_SMALL)
    base, masks = search.stored_apart(emb, F.xxhash64("row_id"), "__h_split", 6, 1, 500, 64, emb.columns)
    from rowsift.operators.population import next_masks
    slots = search.parallel_plan(np.random.default_rng(0), [0, 1], 6, 0.1)
    for step in range(3):
        masks = masks.select("row_id", "label", "__h_split", *next_masks(slots, 500, 1, step, {}, ["mask_0"]), "best")
        if step == 1:
            masks = masks.checkpoint(eager=True)
        masks = masks.persist()
        pop = search.joined(base, masks)
        assert pop.count() == 500
        plan = pop._jdf.queryExecution().executedPlan().toString()
        above = plan.split("InMemoryTableScan")[0]
        assert "SortMergeJoin" in above and "Exchange" not in above
        assert "features" not in masks.columns
    base.unpersist()


# ---------------------------------------------------------------- batch, blocks of training rows, report

def test_datasets_run_at_the_same_time_and_failures_leave_no_cache(spark, tmp_path):
    import threading

    from rowsift.operators.batch import batch_datasets
    for i in range(5):
        folder = tmp_path / "in" / f"d{i}"
        folder.mkdir(parents=True)
        lines = ["x,y0,Class"] + [f"{k % 13}.5,{k % (i + 2)},{k % 2 if i != 3 else 'abc'}" for k in range(120)]
        (folder / "a.csv").write_text("\n".join(lines[:2] if i == 2 else lines) + "\n")
    inside, most, lock = [0], [0], threading.Lock()

    def fitness(rows, n_total):
        with lock:
            inside[0] += 1
            most[0] = max(most[0], inside[0])
        try:
            if rows.count() and rows.select("label").distinct().count() < 2:
                raise RuntimeError("one class only")
            return 0.5
        finally:
            with lock:
                inside[0] -= 1

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    res, err = batch_datasets(spark, str(tmp_path / "in"), out=str(tmp_path / "out"), generations=2, population=4, parents=2, fitness=fitness)
    assert {r.dataset for r in res.collect()} == {"d0/a.csv", "d1/a.csv", "d4/a.csv"}
    failed = {r.dataset: r.error for r in err.collect()}
    assert set(failed) == {"d2/a.csv", "d3/a.csv"} and "one class only" in failed["d3/a.csv"] and most[0] >= 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_ten_training_blocks_equal_one(spark):
    from rowsift.operators import knn
    emb = prepared_embeddings(spark, SF_SMALL)
    q, t = emb.where("row_id % 3 = 0"), emb.where("row_id % 3 > 0")
    one = knn.knn_rank(q, t)
    size = knn._matrix_size(t, "features")
    many = knn.knn_rank(q, t, budget=(size[0] // 10 + 1) * (size[1] * 8 + 16))
    rows = [sorted((r.row_id, r.rank, r.train_id, round(r.distance, 9)) for r in df.select("row_id", "rank", "train_id", "distance").collect())
            for df in (one, many)]
    assert rows[0] == rows[1] and len(rows[0]) == 5 * q.count()


def test_the_report_scans_the_predictions_once(spark):
    from rowsift.operators import metrics
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 0)], "label int, prediction int").mapInArrow(note, "label int, prediction int")
    got = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert seen.value == 11
    assert got["0"].precision == 5 / 6 and got["0"].recall == 5 / 7 and got["2"].f1 == 0 and got["2"].support == 1
    assert got["accuracy"].f1 == 8 / 11 and abs(got["macro avg"].recall - (5 / 7 + 1) / 3) < 1e-12
