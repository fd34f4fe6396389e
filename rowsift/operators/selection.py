"""Fitness of bit-packed candidate subsets (all solutions of a population at once).

Input is a *prepared table* ``(row_id bigint dense 0..n-1, label, features
array<float|double>)`` with mask words. A fitness pass is: one aggregate for the sizes and
class counts of every solution, a bounded exact sample per solution, and one
distributed evaluation pass. Only the bounded training samples and, for solutions whose sample is
stratified (no more classes than sample rows), their class counts reach the driver; a
target may have any number of classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.bits import HASH_RANGE, WORD_BITS, getbit, seeded_hash
from ..session import write_once
from .classes import require_classes
from .knn import KnnSample, evaluate_population
from .order_stats import smallest_k_cutoffs, within_cutoff

FITNESS_COLUMNS = ["solution", "n_selected", "accuracy", "fitness"]
SPLIT_HASH = "__h_split"       # cached seeded hash of the training-sample order
HELD_CLASSES = 50_000          # classes that a task counts before it sends them
HOLD_HASH = "__h_holdout"      # cached seeded hash of the hold-out order


def hcol_name(fitness) -> str:
    return SPLIT_HASH if isinstance(fitness, KnnFitness) else HOLD_HASH


def _hash_col(table: DataFrame, name: str, seed: int, tag: str):
    return F.col(name) if name in table.columns else seeded_hash(seed, tag, "row_id")


@dataclass
class KnnFitness:
    """Fitness of the parallel variant: 5-NN on a stratified sample."""
    k: int = 5
    min_rows: int = 20
    min_classes: int = 2
    train_cap: int = 1000
    train_fraction: float = 0.75
    alpha: float = 0.7
    seed: int = 42
    feature_col: str = "features"
    broadcast_budget: int = 512 << 20


@dataclass
class ForestFitness:
    """Fitness of the sequential variant: random forest on an 80/20 hold-out."""
    num_trees: int = 100
    max_depth: int = 30
    test_fraction: float = 0.2
    alpha: float = 0.7
    seed: int = 42
    feature_col: str = "features"


# ---------------------------------------------------------------- aggregates

@dataclass
class SolutionStats:
    n_selected: int = 0
    n_classes: int = 0
    smallest: int = 0                 # rows of the smallest class
    classes: dict | None = None       # {label: rows}; None if there are more than were asked for


@dataclass
class PopStats:
    """Sizes of all solutions."""
    n: int
    solutions: dict[int, SolutionStats]
    width: int | None = None          # longest feature array


def _selected(rb: pa.RecordBatch, solutions: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(solution, places of the rows it keeps)"""
    words = {}
    for s in solutions:
        w, b = divmod(s, WORD_BITS)
        if w not in words:
            words[w] = np.asarray(rb.column(f"mask_{w}"))
        yield s, np.flatnonzero((words[w] >> b) & 1)


def _mask_cols(solutions: list[int]) -> list[str]:
    return [f"mask_{w}" for w in sorted({s // WORD_BITS for s in solutions})]


def _class_counts(solutions: list[int], kind: pa.DataType):
    """Rows per (class, solution) of a task's rows; sent on when many classes have come up."""
    def table(held: dict) -> pa.RecordBatch:
        counts = np.stack(list(held.values()))
        return pa.RecordBatch.from_arrays([pa.array(list(held), kind), *[pa.array(counts[:, j]) for j in range(counts.shape[1])]],
                                          names=["label", *[f"c{s}" for s in solutions], "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for rb in batches:
            d = rb.column("label").dictionary_encode()
            code = np.asarray(d.indices)
            counts = np.zeros((len(d.dictionary), len(solutions) + 1), np.int64)
            for j, (_, at) in enumerate(_selected(rb, solutions)):
                counts[:, j] = np.bincount(code[at], minlength=len(counts))
            counts[:, -1] = np.bincount(code, minlength=len(counts))
            for lab, c in zip(d.dictionary.to_pylist(), counts):
                held[lab] = held[lab] + c if lab in held else c
            if len(held) > HELD_CLASSES:
                yield table(held)
                held = {}
        if held:
            yield table(held)
    return run


def population_stats(table: DataFrame, solutions: list[int], width_col: str | None = None,
                     most_classes: int = 1000) -> PopStats:
    """Rows, classes and smallest class of every solution, and the rows per class of those with at
    most ``most_classes`` classes.

    Classes are counted inside the tasks and added up by label. Up to ``most_classes`` rows of that are
    fetched; a larger one is written, summed up to one row, and only the classes of the solutions that
    have few of them are fetched."""
    kind = table.schema["label"].dataType
    counted = table.select("label", *_mask_cols(solutions)).where("label is not null").mapInArrow(
        _class_counts(solutions, to_arrow_type(kind)),
        ", ".join([f"label {kind.simpleString()}", *[f"c{s} long" for s in solutions], "n long"]))
    per_class = counted.groupBy("label").agg(*[F.expr(f"sum({c}) as {c}") for c in counted.columns[1:]])
    width = table.agg(F.max(F.size(width_col))).first()[0] if width_col else None
    rows = per_class.limit(most_classes + 1).collect()
    if len(rows) <= most_classes:
        out = {s: SolutionStats(classes={}) for s in solutions}
        for r in rows:
            for s in solutions:
                if r[f"c{s}"]:
                    out[s].classes[r["label"]] = int(r[f"c{s}"])
        for st in out.values():
            if st.classes:
                st.n_selected, st.n_classes = sum(st.classes.values()), len(st.classes)
                st.smallest = min(st.classes.values())
        return PopStats(sum(int(r["n"]) for r in rows), out, width)
    per_class = write_once(per_class, "class-counts")
    sums = [F.expr(e) for s in solutions for e in (f"sum(c{s}) as n{s}", f"count_if(c{s} > 0) as k{s}", f"min(nullif(c{s}, 0)) as m{s}")]
    total = per_class.agg(F.sum("n").alias("n"), *sums).first()
    out = {s: SolutionStats(int(total[f"n{s}"]), int(total[f"k{s}"]), int(total[f"m{s}"] or 0)) for s in solutions}
    few = [s for s in solutions if out[s].n_classes <= most_classes]
    for s in few:
        out[s].classes = {r["label"]: int(r["c"]) for r in
                          per_class.where(F.col(f"c{s}") > 0).select("label", F.col(f"c{s}").alias("c")).collect()}
    return PopStats(int(total["n"]), out, width)


def largest_remainder(total: int, counts: dict) -> dict:
    """Split ``total`` over classes in proportion to ``counts``; leftover units go
    to the largest fractional parts, ties to the smallest label."""
    n = sum(counts.values())
    base = {lab: (total * c) // n for lab, c in counts.items()}
    left = total - sum(base.values())
    order = sorted(counts, key=lambda lab: (-((total * counts[lab]) % n), lab))
    for lab in order[:left]:
        base[lab] += 1
    return base


@dataclass
class TrainPlan:
    solution: int
    n_selected: int
    eligible: bool
    train_size: int = 0
    stratified: bool = False
    alloc: dict = field(default_factory=dict)


def plan_knn_training(stats: dict[int, SolutionStats], cfg: KnnFitness) -> dict[int, TrainPlan]:
    plans = {}
    for s, st in stats.items():
        t = min(cfg.train_cap, int(cfg.train_fraction * st.n_selected))
        if st.n_selected < cfg.min_rows or st.n_classes < cfg.min_classes or t < 2:
            plans[s] = TrainPlan(s, st.n_selected, False)
            continue
        strat = st.smallest >= 2 and t >= st.n_classes and st.n_selected - t >= st.n_classes
        alloc = largest_remainder(t, st.classes) if strat else {None: t}
        plans[s] = TrainPlan(s, st.n_selected, True, t, strat, alloc)
    return plans


def _limit(k: int, n: int, slack: float) -> int:
    """A hash below which, of ``n`` uniform ones, at least ``k`` lie almost surely (and few more)."""
    wanted = k + (6.0 * math.sqrt(k) + 12.0) * slack
    return HASH_RANGE if wanted >= n else int(wanted / n * HASH_RANGE)


def _sample_ids(table: DataFrame, plans: dict[int, TrainPlan], stats: dict[int, SolutionStats], cfg: KnnFitness
                ) -> dict[int, list[int]]:
    """Row ids of every solution's sample: per (solution, class) the ``alloc`` rows with the smallest
    (seeded hash, row id). One pass fetches (solution, label, hash, id) of the rows below a hash that at
    least ``alloc`` rows lie below almost surely; a group that has fewer is asked again with a higher one."""
    h = _hash_col(table, SPLIT_HASH, cfg.seed, "split")
    need = {(s, lab): a for s, p in plans.items() if p.eligible for lab, a in p.alloc.items() if a}
    chosen: dict[int, list[int]] = {s: [] for s, p in plans.items() if p.eligible}
    kind, slack = table.schema["label"].dataType.simpleString(), 1.0
    while need:
        limits: dict[int, dict] = {}           # at most train_cap labels a solution, as each has a sample row
        for (s, lab), a in need.items():
            n = stats[s].n_selected if lab is None else stats[s].classes[lab]
            limits.setdefault(s, {})[lab] = _limit(a, n, slack)
        rows = table.select("row_id", "label", h.alias("h"), *_mask_cols(list(limits))).where("label is not null")
        sent = table.sparkSession.sparkContext.broadcast(limits)
        got = rows.mapInArrow(_below(sent), f"s int, label {kind}, h long, row_id long").toPandas()
        sent.unpersist()
        whole = {s for s, x in limits.items() if None in x}
        groups = {(s, None): part for s, part in got[got.s.isin(whole)].groupby("s")}
        groups |= {(int(s), lab): part for (s, lab), part in got[~got.s.isin(whole)].groupby(["s", "label"])}
        missing = {}
        for key, a in need.items():
            part = groups.get(key)
            if part is None or len(part) < a:
                missing[key] = a
                continue
            order = np.lexsort((part["row_id"].to_numpy(), part["h"].to_numpy()))[:a]
            chosen[key[0]] += part["row_id"].to_numpy()[order].tolist()
        need, slack = missing, slack * 16
    return chosen


def _below(sent):
    """(s, label, h, row_id) of the rows whose hash is below their group's limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limits = sent.value
        for rb in batches:
            d = rb.column("label").dictionary_encode()
            code, names, h = np.asarray(d.indices), d.dictionary.to_pylist(), np.asarray(rb.column("h"))
            for s, at in _selected(rb, list(limits)):
                mine = limits[s]
                if None in mine:
                    low = at[h[at] < mine[None]]
                else:
                    low = at[h[at] < np.array([mine.get(x, 0) for x in names], np.int64)[code[at]]]
                if len(low):
                    part = rb.take(pa.array(low))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(low), s, np.int32)), part.column("label"), part.column("h"),
                                                      part.column("row_id")], names=["s", "label", "h", "row_id"])
    return run


def collect_knn_sample(table: DataFrame, plans: dict[int, TrainPlan], stats: dict[int, SolutionStats],
                       cfg: KnnFitness, masks: DataFrame | None = None) -> KnnSample:
    """Exact stratified sample of every eligible solution, fetched whole (at most ``train_cap`` rows
    a solution, whatever the table size)."""
    ids = _sample_ids(table if masks is None else masks, plans, stats, cfg)
    wanted = pd.DataFrame({"row_id": sorted({i for x in ids.values() for i in x})}, dtype="int64")
    small = table.sparkSession.createDataFrame(wanted, "row_id bigint")
    rows = (table.select("row_id", "label", cfg.feature_col).join(F.broadcast(small), "row_id")
            .toPandas().sort_values("row_id").reset_index(drop=True))
    labels, code = np.unique(np.array(rows["label"].tolist()), return_inverse=True)
    feats = np.vstack(rows[cfg.feature_col].to_numpy()).astype(np.float64) if len(rows) else np.zeros((0, 0))
    sample, known = KnnSample(labels), rows["row_id"].to_numpy(dtype=np.int64)
    for s, mine in ids.items():
        if len(mine) != plans[s].train_size:
            raise RuntimeError(f"sample of solution {s}: {len(mine)} rows, expected {plans[s].train_size}")
        at = np.searchsorted(known, np.sort(np.array(mine, np.int64)))
        sample.feats[s], sample.ids[s], sample.labels[s] = feats[at], known[at], code[at]
    return sample


def weighted_fitness(accuracy: float, n_selected: int, n_total: int, alpha: float) -> float:
    beta = round(1.0 - alpha, 12)   # 0.3, not 0.30000000000000004
    return alpha * accuracy + beta * (1.0 - n_selected / n_total)


def _within_budget(solutions: list[int], plans: dict, width: int | None, budget: int) -> list[list[int]]:
    """Groups of solutions whose samples together fit the budget, known before
    anything is fetched: sample rows x longest feature array x 8 bytes. Without a known
    width each solution is a group."""
    groups: list[list[int]] = []
    used = 0
    for s in solutions:
        size = plans[s].train_size * width * 8 if width else budget
        if not groups or used + size > budget:
            groups.append([])
            used = 0
        groups[-1].append(s)
        used += size
    return groups


def fitness_knn(table: DataFrame, solutions: list[int], cfg: KnnFitness | None = None,
                stats: PopStats | None = None, masks: DataFrame | None = None) -> pd.DataFrame:
    """Fitness of the listed solutions (parallel variant); one row per solution.
    ``stats`` may carry a ``population_stats`` result already computed, ``masks`` the narrow columns
    of ``table`` (row_id, label, hash, mask words) for the passes that need no features."""
    cfg = cfg or KnnFitness()
    if stats is None:
        require_classes(table)
        stats = population_stats(table, solutions, cfg.feature_col, cfg.train_cap)
    mine = {s: stats.solutions[s] for s in solutions}
    plans = plan_knn_training(mine, cfg)
    ok = [s for s in solutions if plans[s].eligible]
    scores = {}
    for group in _within_budget(ok, plans, stats.width, cfg.broadcast_budget):
        sample = collect_knn_sample(table, {s: plans[s] for s in group}, mine, cfg, masks)
        scores |= evaluate_population(table, sample, group, feature_col=cfg.feature_col, k=cfg.k,
                                      broadcast_budget=cfg.broadcast_budget)
    out = []
    for s in solutions:
        p = plans[s]
        if p.eligible:
            correct, total = scores.get(s, (0, 0))
            acc = correct / total if total else 0.0
            out.append((s, p.n_selected, acc, weighted_fitness(acc, p.n_selected, stats.n, cfg.alpha)))
        else:
            out.append((s, p.n_selected, None, 0.0))
    return pd.DataFrame(out, columns=FITNESS_COLUMNS)


def fitness_forest(table: DataFrame, solutions: list[int], cfg: ForestFitness | None = None,
                   stats: PopStats | None = None, masks: DataFrame | None = None) -> pd.DataFrame:
    """Fitness of the sequential variant: per solution a seeded hold-out of
    ``ceil(test_fraction * n)`` rows, a random forest on the rest, accuracy on the
    hold-out, weighted with the share of removed rows. The small forests of a population are
    grown in one job, the others one by one."""
    from .forest import fit_forest, is_small, predict, score_small, side_by_side
    cfg = cfg or ForestFitness()
    if stats is None:
        stats = population_stats(table, solutions, cfg.feature_col)
    n = stats.n
    sizes = {s: stats.solutions[s].n_selected for s in solutions}
    n_test = {s: math.ceil(cfg.test_fraction * sizes[s]) for s in solutions}
    h = _hash_col(table, HOLD_HASH, cfg.seed, "holdout")
    keyed = (table if masks is None else masks).select("row_id", h.alias("h"),
                         F.explode(F.array_compact(F.array(*[F.when(getbit(s) == 1, F.lit(s)) for s in solutions]))).alias("grp"))
    cut = smallest_k_cutoffs(keyed, {s: n_test[s] for s in solutions if sizes[s] > 1})
    small = [s for s in cut if sizes[s] > n_test[s] and stats.width and
             is_small(sizes[s], stats.width, n_test[s], stats.solutions[s].n_classes)]
    scores = score_small(table, {s: cut[s] for s in small}, h, num_trees=cfg.num_trees, max_depth=cfg.max_depth, seed=cfg.seed,
                        feature_col=cfg.feature_col)

    def scored(s: int) -> tuple:
        n_sel = sizes[s]
        if n_sel == 0 or n_sel - n_test[s] < 1 or (s in scores and scores[s] is None):
            return s, n_sel, None, 0.0
        if s in scores:
            return s, n_sel, scores[s], weighted_fitness(scores[s], n_sel, n, cfg.alpha)
        part = table.where(getbit(s) == 1).withColumn("h", h).withColumn("grp", F.lit(s))
        is_test = within_cutoff({s: cut[s]})
        train = part.where(~is_test)
        test = part.where(is_test)
        model = None
        try:
            model = fit_forest(train, num_trees=cfg.num_trees, max_depth=cfg.max_depth,
                               seed=cfg.seed, feature_col=cfg.feature_col)
            pred = predict(model, test, feature_col=cfg.feature_col)
            acc = pred.agg(F.avg((F.col("prediction") == F.col("label"))
                                 .cast("double"))).first()[0] or 0.0
        except IllegalArgumentException:      # the model's own refusal (e.g. one class) scores 0
            return s, n_sel, None, 0.0
        finally:
            if model is not None:
                model.release()
        return s, n_sel, acc, weighted_fitness(acc, n_sel, n, cfg.alpha)

    return pd.DataFrame(side_by_side(table.sparkSession, scored, solutions), columns=FITNESS_COLUMNS)


def fitness_custom(custom: Callable[[DataFrame, int], float], table: DataFrame, solutions: list[int],
                   stats: PopStats) -> pd.DataFrame:
    """A caller's own strategy: ``custom(selected_rows, n_total)`` is the fitness of
    the solution; ``accuracy`` stays empty."""
    out = []
    for s in solutions:
        n_sel = stats.solutions[s].n_selected
        out.append((s, n_sel, None, float(custom(table.where(getbit(s) == 1), stats.n))))
    return pd.DataFrame(out, columns=FITNESS_COLUMNS)
