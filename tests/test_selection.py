"""Row-selection operators: fitness rules, genetic operators, search invariants."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rowsift.functions.bits import getbit, pack_bits, random_masks, seeded_hash
from rowsift.operators.knn import neighbours, vote
from rowsift.operators.order_stats import smallest_k_cutoffs, within_cutoff
from rowsift.operators.population import Mutation, Slot, flip_expr, mutation_cutoffs, slot_bit
from rowsift.operators.search import evolve
from rowsift.operators.selection import (KnnFitness, SolutionStats, fitness_knn, largest_remainder,
                                         plan_knn_training, weighted_fitness)
from rowsift.sources.tables import prepared_embeddings


def table(spark, n, classes, d=4, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, int(classes[i % len(classes)]), [float(x) for x in rng.normal(size=d)])
            for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, label int, features array<double>")


def with_mask(df, keep_ids_per_solution):
    bits = [F.col("row_id").isin(list(ids)).cast("bigint") for ids in keep_ids_per_solution]
    return df.select("*", *pack_bits(bits))


def test_weighted_fitness_example():
    assert weighted_fitness(0.9, 50, 100, 0.7) == pytest.approx(0.78)


def test_fitness_knn_small_subsets(spark):
    df = table(spark, 100, [0, 1])
    pop = with_mask(df, [range(19), [i for i in range(40) if i % 2 == 0], range(20), range(100)])
    f = fitness_knn(pop, [0, 1, 2, 3]).set_index("solution")
    assert f.loc[0, "fitness"] == 0.0          # 19 rows
    assert f.loc[1, "fitness"] == 0.0          # 20 rows, one class
    assert f.loc[2, "fitness"] > 0.0           # 20 rows, 2 classes
    assert f.loc[3, "n_selected"] == 100
    assert 0.0 <= f["fitness"].max() <= 1.0


def test_train_sizes_and_fallback():
    cfg = KnnFitness()
    stats = {s: SolutionStats(sum(c.values()), len(c), min(c.values()), c)
             for s, c in enumerate([{0: 10, 1: 10}, {0: 1000, 1: 1000}, {0: 1, 1: 30}])}
    plans = plan_knn_training(stats, cfg)
    assert plans[0].train_size == 15 and plans[0].stratified
    assert sum(plans[0].alloc.values()) == 15
    assert plans[1].train_size == 1000 and plans[1].alloc == {0: 500, 1: 500}
    assert not plans[2].stratified and plans[2].alloc == {None: 23}
    assert largest_remainder(10, {0: 1, 1: 1, 2: 1}) == {0: 4, 1: 3, 2: 3}


def test_sample_is_stratified_and_exact(spark):
    from rowsift.operators.selection import collect_knn_sample, population_stats
    df = table(spark, 400, [0, 1, 1, 2])
    pop = df.select("*", *random_masks(5, 3)).persist()
    stats = population_stats(pop, [0, 1, 2]).solutions
    plans = plan_knn_training(stats, KnnFitness())
    smp = collect_knn_sample(pop, plans, stats, KnnFitness())
    for s in range(3):
        assert len(smp.ids[s]) == plans[s].train_size
        got = {c: int((smp.labels[s] == i).sum()) for i, c in enumerate(smp.classes)}
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in plans[s].alloc.items() if v}


def test_smallest_k_matches_window(spark):
    rng = np.random.default_rng(1)
    rows = [(int(g), int(rng.integers(0, 1 << 60)), i) for i, g in
            enumerate(rng.integers(0, 5, size=3000))]
    df = spark.createDataFrame(rows, "grp long, h long, row_id long")
    k = {0: 10, 1: 300, 2: 1, 3: 5000, 4: 0}
    cut = smallest_k_cutoffs(df, k, bits_per_level=4, collect_limit=50)
    got = {(r.grp, r.row_id) for r in df.where(within_cutoff(cut)).collect()}
    w = Window.partitionBy("grp").orderBy("h", "row_id")
    ranked = df.withColumn("rn", F.row_number().over(w)).collect()
    exp = {(r.grp, r.row_id) for r in ranked if r.rn <= k.get(r.grp, 0)}
    assert got == exp


def test_neighbours_brute_force():
    rng = np.random.default_rng(3)
    xt = rng.normal(size=(200, 8))
    xt[5] = xt[7]                              # duplicate vector: tie by id
    xq = np.vstack([rng.normal(size=(50, 8)), xt[:10]])
    tid = np.arange(200) * 3
    top = neighbours(xq, xt, tid, 5, margin=1)
    for r in range(len(xq)):
        d = ((xq[r] - xt) ** 2).sum(1)
        exp = np.lexsort((tid, d))[:5]
        assert list(top[r]) == list(exp)
    assert list(vote(np.array([[1, 1, 0, 0, 2], [4, 3, 2, 1, 0], [9, 9, 9, 1, 1]]))) == [0, 0, 9]


def test_exact_flip_count(spark):
    n = 997
    df = spark.range(n).withColumnRenamed("id", "row_id")
    mutations = [Mutation(u, 1 - u, rate=0.10) for u in (0.0, 0.1, 0.5, 0.93)] + [Mutation(0.3, 0.3, percent=0.01)]
    cuts = mutation_cutoffs(spark, n, [*mutations, Mutation(0.2, 0.2, rate=0.0001)])
    assert len(cuts) == 5
    got = df.select(*[F.sum(flip_expr(mu, n, cuts)) for mu in mutations]).first()
    assert list(got) == [99, 99, 99, 99, 1]
    assert df.where(flip_expr(Mutation(0.2, 0.2, rate=0.0001), n, cuts) == 1).count() == 0


def test_one_point_child(spark):
    n = 50
    df = spark.range(n).withColumnRenamed("id", "row_id").select(
        "row_id", F.lit(0b01).cast("bigint").alias("mask_0"))     # parent 0 all 1, parent 1 all 0
    sl = Slot("one_point", 0, 1, u_cut=0.5)
    cut = 1 + int(0.5 * (n - 2))
    bits = {r.row_id: r.b for r in df.select("row_id", slot_bit(sl, n, 1, 0, {}).alias("b")).collect()}
    assert all(bits[i] == (1 if i < cut else 0) for i in range(n))


def test_search_invariants(spark):
    emb = prepared_embeddings(spark, SF_SMALL)
    hist = []
    res = evolve(emb, generations=4, population=8, parents=4, seed=3, on_generation=hist.append,
                 checkpoint_every=2)
    best = [h["best_so_far"] for h in hist]
    assert best == sorted(best) and len(hist) == 4
    f = res.fitness
    assert ((f["fitness"] >= 0) & (f["fitness"] <= 1)).all()
    for g in range(1, 4):                         # parents survive unchanged
        prev = f[f.generation == g - 1].sort_values(["fitness", "solution"]).tail(4)
        cur = f[f.generation == g].set_index("solution")
        assert sorted(cur.loc[[0, 1, 2, 3], "fitness"]) == sorted(prev["fitness"])
    chosen = res.table.where("best = 1")
    assert chosen.count() == f.loc[f.fitness.idxmax(), "n_selected"]      # first index of the maximum
    assert chosen.join(emb, "row_id", "left_anti").count() == 0
    res2 = evolve(emb, generations=4, population=8, parents=4, seed=3)
    a = sorted(r.row_id for r in res.table.where("best = 1").collect())
    b = sorted(r.row_id for r in res2.table.where("best = 1").collect())
    assert a == b and res.best_fitness == res2.best_fitness


def test_hash_is_stable(spark):
    df = spark.range(3).select(seeded_hash(42, "t", F.col("id")).alias("h"))
    hs = [r.h for r in df.orderBy("h").collect()]
    assert all(0 <= h < (1 << 60) for h in hs) and len(set(hs)) == 3


def test_knn_chunked_equals_single_broadcast(spark):
    from rowsift.operators.knn import collect_train, knn_neighbours, knn_predict, knn_topk, vote_predictions
    q = table(spark, 300, [0, 1, 2], d=6, seed=4)
    t = table(spark, 120, [0, 1, 2, 2], d=6, seed=5)
    one = {(r.row_id, r.rank): r.train_id for r in knn_neighbours(q, collect_train(t)).collect()}
    small = knn_topk(q, t, budget=20 * (6 * 8 + 16))          # forces 6 chunks
    many = {(r.row_id, r.rank): r.train_id for r in small.collect()}
    assert one == many
    p1 = {r.row_id: r.prediction for r in knn_predict(q, collect_train(t)).collect()}
    p2 = {r.row_id: r.prediction for r in vote_predictions(small).collect()}
    assert p1 == p2


def test_population_wider_than_one_word(spark):
    emb = prepared_embeddings(spark, SF_SMALL)
    pop = emb.select("*", *random_masks(9, 64)).persist()
    assert [c for c in pop.columns if c.startswith("mask_")] == ["mask_0", "mask_1"]
    wide = fitness_knn(pop, [61, 62]).set_index("solution")
    narrow_pop = pop.select("row_id", "label", "features", *pack_bits([getbit(61), getbit(62)]))
    narrow = fitness_knn(narrow_pop, [0, 1]).set_index("solution")
    assert list(wide["fitness"]) == list(narrow["fitness"])
    res = evolve(emb, generations=2, population=64, parents=4, seed=9)
    f = res.fitness
    prev = f[f.generation == 0].sort_values(["fitness", "solution"]).tail(4)
    cur = f[f.generation == 1].set_index("solution")
    assert sorted(cur.loc[[0, 1, 2, 3], "fitness"]) == sorted(prev["fitness"])


def test_next_words_equal_the_column_expressions(spark):
    from rowsift.operators.population import next_masks, parallel_plan, slot_cutoffs, steady_state_plan
    n = 333
    df = spark.range(n).withColumnRenamed("id", "row_id").select("row_id", *random_masks(4, 70))
    rng = np.random.default_rng(5)
    for slots in (parallel_plan(rng, [3, 61, 8, 65], 70, 0.1), steady_state_plan(rng, [62, 1, 2, 69], 70, 10.0)):
        cuts = slot_cutoffs(spark, n, slots)
        a = df.select("row_id", *pack_bits([slot_bit(sl, n, 4, 2, cuts) for sl in slots]))
        b = df.select("row_id", *next_masks(slots, n, 4, 2, cuts, ["mask_0", "mask_1"]))
        assert sorted(a.collect()) == sorted(b.collect())


def test_string_labels_search(spark):
    emb = prepared_embeddings(spark, SF_SMALL).withColumn(
        "label", F.concat(F.lit("c"), F.col("label").cast("string")))
    res = evolve(emb, generations=2, population=6, parents=2, seed=2)
    assert ((res.fitness["fitness"] >= 0) & (res.fitness["fitness"] <= 1)).all()
    assert res.fitness["accuracy"].notna().any()
    assert res.table.where("best = 1").count() > 0


def test_selected_rows_match_the_best_solution(spark):
    from rowsift.operators.search import select_instances, selection_summary
    emb = prepared_embeddings(spark, SF_SMALL)
    rows, res = select_instances(emb, generations=3, population=8, parents=4, seed=21)
    f = res.fitness
    best = f[f.fitness == res.best_fitness].sort_values(["generation", "solution"]).iloc[0]
    assert rows.count() == best.n_selected
    summ = selection_summary(res.table).first()
    assert summ.original_rows == 500 and summ.selected_rows == best.n_selected
    assert summ.reduction_pct == round((1 - best.n_selected / 500) * 100, 2)
    res.release()
