"""The sequential search with forest fitness runs the reference's 50 generations of 20 solutions, whose forests are grown
in one job a generation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowsift.functions.bits import xxhash64_rows
from rowsift.operators import forest, search, trees
from rowsift.operators.selection import FITNESS_COLUMNS, ForestFitness, fitness_forest
from rowsift.plans import q_forest


@pytest.fixture
def folder(tmp_path):
    """90 rows of three classes."""
    rng = np.random.default_rng(5)
    x, y = rng.random((90, 6)).astype(np.float32), np.arange(90) % 3
    x[:, 0] += y
    pd.DataFrame({"vec_id": np.arange(90), "embedding": list(x), "label": y.astype(np.int32)}).to_parquet(tmp_path / "embeddings.parquet")
    return str(tmp_path)


def test_sequential_search_scores_all_generations(spark, folder, monkeypatch):
    """One elite is kept, so 20 + 50 x 19 solutions are scored, each by a forest of 100 trees."""
    asked, plans, plan = [], [], search.steady_state_plan

    def scored(pop, todo, cfg, stats, masks):
        asked.append((len(todo), cfg.num_trees))
        sizes = [stats.solutions[s].n_selected for s in todo]
        return pd.DataFrame([(s, n, 0.5, 1 - n / stats.n) for s, n in zip(todo, sizes)], columns=FITNESS_COLUMNS)

    def planned(rng, parents, population, percent):
        plans.append((len(parents), population, percent))
        return plan(rng, parents, population, percent)

    monkeypatch.setattr(search, "fitness_forest", scored)
    monkeypatch.setattr(search, "steady_state_plan", planned)
    rows = q_forest.q_evolve_sequential(spark, folder).collect()
    assert asked == [(20, 100)] + 50 * [(19, 100)]
    assert plans == 50 * [(4, 20, 10.0)]
    assert 0 < len(rows) < 90


def population(spark, n=260, width=5, labels=3, kind="float"):
    """Rows with four solutions: random ones, one of few rows, one of a single class; some rows come twice."""
    rng = np.random.default_rng(8)
    rows = [(i, int(rng.integers(labels)) - 1, rng.integers(0, 40, width).astype(float).tolist()) for i in range(n)]
    rows = [(i, y, [v + 9 * y for v in x], int(rng.integers(4)) | 4 * (i < 2) | 8 * (y == 1)) for i, y, x in rows]
    rows += rows[:30] + [(n + i, *r[1:]) for i, r in enumerate(rows[:20])]
    return spark.createDataFrame(rows, f"row_id long, label int, features array<{kind}>, mask_0 long").persist()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_forests_of_a_population_are_those_grown_one_by_one(spark, monkeypatch, kind):
    table, cfg = population(spark, kind=kind), ForestFitness(num_trees=20)
    asked, score = [], forest.score_small
    monkeypatch.setattr(forest, "score_small", lambda *a, **kw: asked.append(score(*a, **kw)) or asked[-1])
    one_job = fitness_forest(table, [0, 1, 2, 3], cfg)
    assert set(asked[0]) == {0, 1, 2, 3} and asked[0][3] is None
    monkeypatch.setattr(forest, "is_small", lambda *a: False)
    pd.testing.assert_frame_equal(one_job, fitness_forest(table, [0, 1, 2, 3], cfg))
    assert asked[1] == {} and one_job["accuracy"][0] > 0.5


def test_uneven_or_missing_rows_are_left_to_the_other_steps(spark):
    """No forest is grown over what is there of them."""
    good = population(spark)
    for bad in ("NULL, array(1f, 2f, 3f, 4f, 5f)", "1, array(1f)", "1, array(1f, NULL, 3f, 4f, 5f)"):
        table = good.union(spark.sql(f"SELECT 900L, {bad}, 3L"))
        got = forest.score_small(table, {0: (1 << 59, 0), 1: (1 << 59, 0)}, F.shiftleft("row_id", 50), num_trees=4, max_depth=5, seed=1, feature_col="features")
        assert got == {}


@pytest.mark.parametrize("size", [1, 5, 8, 31, 32, 64, 77])
def test_hash_of_rows_is_sparks(spark, size):
    rng = np.random.default_rng(size)
    x, y = rng.integers(0, 256, (9, size)).astype(np.uint8), rng.integers(-3, 9, 9)
    df = spark.createDataFrame([(i, bytearray(v.tobytes()), int(c)) for i, (v, c) in enumerate(zip(x, y))], "i int, x binary, y int")
    assert xxhash64_rows(x, y).astype(np.int64).tolist() == [r[0] for r in df.orderBy("i").select(F.xxhash64("x", "y")).collect()]


@pytest.mark.parametrize("n, classes, d, bins", [(150, 3, 9, 32), (900, 10, 16, 32), (60, 40, 3, 5), (7, 2, 2, 4)])
def test_trees_grown_together_are_those_grown_alone(n, classes, d, bins):
    rng = np.random.default_rng(n)
    x, y = rng.integers(0, bins, (n, d)).astype(np.uint8), rng.integers(0, classes, n)
    rows = [np.sort(rng.choice(n, max(1, n // (t + 1)), replace=False)) for t in range(4)]
    w = [rng.integers(1, 4, len(r)) for r in rows]
    kw = dict(classes=classes, bins=bins, s=min(d, 3), depth=0, max_depth=30)
    many = trees.grow(x, y, np.concatenate(w), None, rng=[np.random.default_rng(t) for t in range(4)], row=np.concatenate(rows),
                      root=np.repeat(np.arange(4), [len(r) for r in rows]), **kw)
    for t, at in enumerate(trees.route(many, x, 4).reshape(4, -1)):
        one = trees.grow(x[rows[t]], y[rows[t]], w[t], None, rng=np.random.default_rng(t), **kw)
        for a, b in zip(trees.route(one, x), at):
            for k in ("cls", "p"):
                assert np.array_equal(one[k][one["start"][a]:one["stop"][a]], many[k][many["start"][b]:many["stop"][b]])


@pytest.mark.parametrize("n, classes", [(40, 40), (700, 4)])
def test_splits_are_the_best_of_all(n, classes):
    """Few rows (sorted) and many (histograms): the cut of highest gini gain, by plain counting."""
    rng = np.random.default_rng(n)
    x, w = rng.integers(0, 32, (n, 2)).astype(np.uint8), rng.integers(1, 4, n)
    y = np.where(rng.random(n) < 0.2, rng.integers(0, classes, n), x[:, 1] > 12)
    tree = trees.grow(x, y, w, None, classes=classes, bins=32, s=2, depth=0, max_depth=1, rng=np.random.default_rng(1))

    def purity(rows):
        c = np.bincount(y[rows], w[rows], classes)
        return (c * c).sum() / c.sum() if c.sum() else 0.0
    gains = {(f, b): purity(x[:, f] <= b) + purity(x[:, f] > b) for f in range(2) for b in range(32)}
    assert np.isclose(gains[tree["feature"][0], tree["cut"][0]], max(gains.values()))


def test_split_points_are_those_of_a_scan():
    rng = np.random.default_rng(2)
    for n, bins in ((50, 32), (999, 32), (999, 7), (3000, 2), (40, 64)):
        for values in (rng.normal(size=n), rng.integers(0, 45, n) / 4, np.minimum(rng.normal(size=n), 0)):
            distinct, counts = np.unique(values, return_counts=True)
            middle, out = (distinct[:-1] + distinct[1:]) / 2, []
            stride = target = n / bins
            for i, said in enumerate(np.cumsum(counts)[1:]):
                if abs(said - counts[i + 1] - target) < abs(said - target):
                    out.append(middle[i])
                    target += stride
            expected = middle if len(middle) < bins else np.array(out[:bins - 1])
            assert np.array_equal(trees.split_points(values, bins), expected)
