"""Row-selection queries over the embedding table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bits import random_masks
from ..operators.search import (best_of_generation, evolve, fitness_history, log_folder, search_log, select_instances,
                                selection_summary, track_best)
from ..operators.selection import KnnFitness, fitness_knn
from ..sources.tables import prepared_embeddings
from .catalog import register
from .sql_selection import fitness_knn_sql, population_sql

SEED = 42
POPULATION = 20


def _to_frame(spark, pdf, schema):
    return spark.createDataFrame(pdf, schema=schema)


FITNESS_SCHEMA = "solution int, n_selected bigint, accuracy double, fitness double"


def _rounded(df):
    return df.select("solution", "n_selected", F.round("accuracy", 6).alias("accuracy"),
                     F.round("fitness", 6).alias("fitness"))


@register("fitness_knn", fitness_knn_sql(population_sql(SEED, POPULATION), POPULATION, seed=SEED))
def q_fitness_knn(spark, sf_dir):
    """Generation 0 of the parallel search: 20 seeded random subsets of the
    embedding table, each scored by 5-NN trained on a stratified sample of at
    most 1000 of its rows, weighted with the share of removed rows."""
    pop = prepared_embeddings(spark, sf_dir).select("*", *random_masks(SEED, POPULATION))
    pop = pop.persist()
    f = fitness_knn(pop, list(range(POPULATION)), KnnFitness(seed=SEED))
    pop.unpersist()
    return _rounded(_to_frame(spark, f, FITNESS_SCHEMA))


# The reference's configuration of the parallel search; one logged search serves all queries that read it.
PARENTS = 4
RATE = 0.10
DEFAULTS = dict(generations=50, population=POPULATION, parents=PARENTS, mutation_rate=RATE, seed=SEED)


def _search(spark, sf_dir):
    """The finished search, replayed from its log where that is whole."""
    table = prepared_embeddings(spark, sf_dir)
    return evolve(table, log=log_folder(table, **DEFAULTS), **DEFAULTS)


def _log(spark, sf_dir):
    return search_log(prepared_embeddings(spark, sf_dir), **DEFAULTS)


def flagship(spark, sf_dir):
    """The selected rows of the seeded parallel search (5-NN fitness, 50 generations of 20 solutions)."""
    return _search(spark, sf_dir).table.where(F.col("best") == 1).select("row_id", "label")


# ------------------------------------------------------------------ population operators

import numpy as np  # noqa: E402

from ..functions.bits import getbit, pack_bits  # noqa: E402
from ..operators.population import Mutation, Slot, parallel_plan, slot_bit, slot_cutoffs  # noqa: E402
from .sql_selection import evolve_parallel_sql, next_population_sql, population_sql as _pop_sql  # noqa: E402


def _population(spark, d):
    return prepared_embeddings(spark, d).select("*", *random_masks(SEED, POPULATION))


def _unpivot_counts(df, prefix, value):
    cols = [c for c in df.columns if c.startswith(prefix)]
    ids = [c for c in df.columns if not c.startswith(prefix)]
    return (df.unpivot(ids, cols, "__name", value)
            .withColumn("solution", F.regexp_extract("__name", r"(\d+)$", 1).cast("int"))
            .drop("__name"))


POP0 = f"SELECT * FROM ({_pop_sql(SEED, POPULATION)})"


@register("init_population", f"SELECT row_id, mask_0 FROM ({_pop_sql(SEED, POPULATION)})")
def q_init_population(spark, d):
    """20 seeded random 0/1 vectors over the embedding rows, packed in one
    bigint per row (bit s = solution s)."""
    return _population(spark, d).select("row_id", "mask_0")


@register("count_selected", f"""
SELECT CAST(s.range AS INTEGER) AS solution, CAST(sum((mask_0 >> s.range) & 1) AS BIGINT) AS n_selected
FROM ({POP0}) p, range(0, {POPULATION}) s GROUP BY s.range""")
def q_count_selected(spark, d):
    """Rows kept by every solution: one aggregate with one sum per solution."""
    pop = _population(spark, d)
    agg = pop.agg(*[F.sum(getbit(s)).alias(f"c{s}") for s in range(POPULATION)])
    return _unpivot_counts(agg, "c", "n_selected").select("solution", "n_selected")


CLASS_COUNTS_SQL = f"""
SELECT CAST(s.range AS INTEGER) AS solution, label, CAST(count(*) AS BIGINT) AS n
FROM ({POP0}) p, range(0, {POPULATION}) s WHERE ((mask_0 >> s.range) & 1) = 1
GROUP BY s.range, label"""


@register("class_counts", CLASS_COUNTS_SQL)
def q_class_counts(spark, d):
    """Members per class per solution (input of the stratified allocation)."""
    pop = _population(spark, d)
    agg = pop.groupBy("label").agg(*[F.sum(getbit(s)).alias(f"c{s}") for s in range(POPULATION)])
    return (_unpivot_counts(agg, "c", "n").where(F.col("n") > 0)
            .select("solution", "label", "n"))


@register("distinct_classes", f"""
SELECT solution, CAST(count(*) AS BIGINT) AS n_classes FROM ({CLASS_COUNTS_SQL}) GROUP BY solution""")
def q_distinct_classes(spark, d):
    return q_class_counts(spark, d).groupBy("solution").agg(F.count(F.lit(1)).alias("n_classes"))


def _gen0_fitness(spark, d):
    return q_fitness_knn(spark, d)


FIT0 = fitness_knn_sql(population_sql(SEED, POPULATION), POPULATION, seed=SEED)


@register("fitness_weighted", f"SELECT solution, fitness FROM ({FIT0})")
def q_fitness_weighted(spark, d):
    """0.7 * accuracy + 0.3 * share of removed rows, per solution."""
    return _gen0_fitness(spark, d).select("solution", "fitness")


@register("top_parents", f"""
SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY fitness DESC, solution DESC) AS INTEGER) AS rank,
                      solution, fitness FROM ({FIT0})) WHERE rank <= {PARENTS}""")
def q_top_parents(spark, d):
    """The 4 fittest solutions (ties to the larger index): a top-k, no full sort."""
    f = _gen0_fitness(spark, d).orderBy(F.col("fitness").desc(), F.col("solution").desc()) \
        .limit(PARENTS)
    rows = f.collect()
    return spark.createDataFrame([(i + 1, r["solution"], r["fitness"]) for i, r in enumerate(rows)],
                                 "rank int, solution int, fitness double")


@register("best_solution", f"""
SELECT arg_max(solution, (fitness, -solution)) AS solution, max(fitness) AS fitness FROM ({FIT0})""")
def q_best_solution(spark, d):
    f = _gen0_fitness(spark, d)
    return f.agg(F.max_by("solution", F.struct("fitness", -F.col("solution"))).alias("solution"),
                 F.max("fitness").alias("fitness"))


def _apply(spark, d, slots, generation=0):
    pop = _population(spark, d)
    n = pop.count()
    cuts = slot_cutoffs(spark, n, slots)
    bits = [slot_bit(sl, n, SEED, generation, cuts) for sl in slots]
    return pop.select("row_id", *pack_bits(bits))


def _apply_sql(slots, generation=0):
    return (f"SELECT row_id, mask_0 FROM ("
            f"{next_population_sql(_pop_sql(SEED, POPULATION), slots, POPULATION, SEED, generation)})")


def _one_point_slots():
    rng = np.random.default_rng(7)
    out = []
    for _ in range(POPULATION - PARENTS):
        i, j = rng.choice(PARENTS, 2, replace=False)
        out.append(Slot("one_point", int(i), int(j), u_cut=float(rng.random())))
    return out


ONE_POINT = _one_point_slots()
UNIFORM = [Slot("uniform", i % PARENTS, (i + 1) % PARENTS, coin=i) for i in range(POPULATION - 1)]
_rng = np.random.default_rng(11)
MUT_EXACT = [Slot("copy", s, mutation=Mutation(float(_rng.random()), float(_rng.random()), rate=RATE))
             for s in range(POPULATION)]
MUT_RANDOM = [Slot("copy", s, mutation=Mutation(float(_rng.random()), float(_rng.random()),
                                                 percent=10.0)) for s in range(POPULATION)]
NEXT_POP = parallel_plan(np.random.default_rng(SEED), list(range(PARENTS)), POPULATION, RATE)


@register("crossover_one_point", _apply_sql(ONE_POINT))
def q_crossover_one_point(spark, d):
    """16 children of parents 0..3: rows below the cut from the first parent."""
    return _apply(spark, d, ONE_POINT)


@register("crossover_uniform", _apply_sql(UNIFORM))
def q_crossover_uniform(spark, d):
    """19 children of parents (i, i+1 mod 4), each gene from either by a seeded coin."""
    return _apply(spark, d, UNIFORM)


@register("mutate_exact", _apply_sql(MUT_EXACT))
def q_mutate_exact(spark, d):
    """Every solution with exactly int(0.1 n) distinct genes flipped."""
    return _apply(spark, d, MUT_EXACT)


@register("mutate_random", _apply_sql(MUT_RANDOM))
def q_mutate_random(spark, d):
    """Every solution with max(1, int(10 n / 100)) genes set to the other value."""
    return _apply(spark, d, MUT_RANDOM)


@register("next_population", _apply_sql(NEXT_POP))
def q_next_population(spark, d):
    """Parents 0..3 kept, 16 one-point children with exact mutation."""
    return _apply(spark, d, NEXT_POP)


# ------------------------------------------------------------------ the search (50 generations)

EVO = evolve_parallel_sql(SEED, POPULATION, PARENTS, RATE, DEFAULTS["generations"])


def _rounded_log(log):
    return log.select("generation", "solution", "n_selected", F.round("accuracy", 6).alias("accuracy"),
                      F.round("fitness", 6).alias("fitness"))


@register("evolve", EVO["fitness"])
def q_evolve(spark, d):
    """Fitness of every solution of all 50 generations, from the search's log."""
    return _rounded_log(_log(spark, d))


@register("fitness_history", EVO["history"])
def q_fitness_history(spark, d):
    """Per generation best, best so far and generations without improvement."""
    return fitness_history(_log(spark, d)).select(
        "generation", F.round("best", 6).alias("best"), F.round("best_so_far", 6).alias("best_so_far"), "stall")


@register("select_instances", EVO["rows"])
def q_select_instances(spark, d):
    """Rows of the best solution found by the 50 generations of the parallel search."""
    rows, _ = select_instances(prepared_embeddings(spark, d),
                               log=log_folder(prepared_embeddings(spark, d), **DEFAULTS), **DEFAULTS)
    return rows.select("row_id", "label")


# ------------------------------------------------------------------ more selection operators

@register("gather_rows", f"""
SELECT row_id, label FROM ({POP0}) WHERE (mask_0 & 1) = 1""")
def q_gather_rows(spark, d):
    """Rows kept by solution 0 of the initial population (a bit filter on the
    row, no join)."""
    return _population(spark, d).where(getbit(0) == 1).select("row_id", "label")


@register("select_parents", f"""
SELECT CAST(row_number() OVER (ORDER BY fitness, solution) - 1 - {POPULATION - PARENTS} AS INTEGER) AS slot,
       solution FROM ({FIT0}) QUALIFY slot >= 0""")
def q_select_parents(spark, d):
    """The 4 parents in the order they take slots 0..3 of the next population
    (ascending fitness, ties to the larger index last)."""
    f = _gen0_fitness(spark, d).orderBy(F.col("fitness").desc(), F.col("solution").desc()) \
        .limit(PARENTS).collect()
    return spark.createDataFrame([(PARENTS - 1 - i, r["solution"]) for i, r in enumerate(f)],
                                 "slot int, solution int")


@register("best_of_generation", EVO["of_generation"])
def q_best_of_generation(spark, d):
    """Best fitness and its solution (ties to the smaller index) per generation."""
    return best_of_generation(_rounded_log(_log(spark, d)))


@register("selection_summary", f"""
SELECT (SELECT count(*) FROM embeddings) AS original_rows, count(*) AS selected_rows,
       round((1 - count(*) / (SELECT count(*) FROM embeddings)) * 100, 2) AS reduction_pct
FROM ({EVO["rows"]})""")
def q_selection_summary(spark, d):
    """Original and kept rows of the search and the reduction in percent (2 decimals),
    from one aggregate over the flagged table."""
    return selection_summary(_search(spark, d).table, "best")


@register("track_best", EVO["best"])
def q_track_best(spark, d):
    """Best-ever solution of the search (strict improvement): the generation
    it was found in, its index then, its fitness."""
    return track_best(_log(spark, d)).withColumn("fitness", F.round("fitness", 6))


@register("search_defaults", EVO["rows"])
def q_search_defaults(spark, d):
    """The reference's configuration of the parallel search: 50 generations of 20 solutions, 4
    parents, 10% mutation, 5-NN fitness; rows of the best-ever solution, searched without a log."""
    rows, _ = select_instances(prepared_embeddings(spark, d), **DEFAULTS)
    return rows.select("row_id", "label")


from .sql_selection import evolve_sequential_sql  # noqa: E402

SEQ = evolve_sequential_sql(SEED, POPULATION, PARENTS, RATE, DEFAULTS["generations"])
SEQUENTIAL = DEFAULTS | dict(variant="sequential", fitness=KnnFitness(seed=SEED))


@register("evolve_sequential_knn", SEQ["fitness"])
def q_evolve_sequential_knn(spark, d):
    """Sequential variant (one elite, uniform crossover, at-least-one-gene
    mutation) scored by 5-NN: fitness of the 51 evaluated populations of the search, from its log."""
    return _rounded_log(search_log(prepared_embeddings(spark, d), **SEQUENTIAL))


@register("select_instances_sequential", SEQ["rows"])
def q_select_instances_sequential(spark, d):
    """Rows of the best solution of the last population of the sequential
    variant (5-NN fitness, 50 generations)."""
    table = prepared_embeddings(spark, d)
    res = evolve(table, log=log_folder(table, **SEQUENTIAL), **SEQUENTIAL)
    return res.table.where(F.col("best") == 1).select("row_id", "label")
