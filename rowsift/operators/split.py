"""Seeded and stratified splits, within-class ranks and cross-validation folds.

Randomness is the seeded 60-bit hash of the row id, so a split is the set of
rows with the smallest hashes; exact cut-offs come from
:func:`smallest_k_cutoffs` (radix refinement, no global sort) or, per class, from
:func:`class_cutoffs`, positions from :func:`ordered_positions` (per-partition offsets, no
single-task window). Per-class numbers are tables joined on the label, so a target may have any
number of classes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bits import seeded_hash
from ..functions.literals import named
from ..session import write_once
from .classes import allocated, class_cutoffs, class_table, join_classes, require_classes
from .order_stats import smallest_k_cutoffs, within_cutoff
from .rowid import ordered_positions


def holdout_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42,
                  id_col: str = "row_id") -> DataFrame:
    """Adds ``is_test``: the ``ceil(test_fraction * n)`` rows with the smallest
    seeded hash are the hold-out."""
    return _smallest(df, math.ceil(test_fraction * df.count()), seeded_hash(seed, "holdout", id_col), id_col, "is_test")


def _smallest(df: DataFrame, k: int, h, id_col: str, out_col: str) -> DataFrame:
    """Adds ``out_col``: whether the row is among the ``k`` smallest (h, id)."""
    keyed = df.select(F.lit(0).alias("grp"), h.alias("h"), F.col(id_col).alias("row_id"))
    cut = smallest_k_cutoffs(keyed, {0: k})
    return (df.withColumn("__h", h).withColumn("__g", F.lit(0))
            .withColumn(out_col, within_cutoff(cut, group_col="__g", order_col="__h", id_col=id_col))
            .drop("__h", "__g"))


def stratified_split(df: DataFrame, train_size: int | None = None, seed: int = 42,
                     label: str = "label", id_col: str = "row_id", cap: int = 1000,
                     fraction: float = 0.75) -> DataFrame:
    """Adds ``in_train``: class-proportional sample of ``train_size`` rows
    (default ``min(cap, int(fraction * n))``), largest-remainder allocation with
    ties to the smallest label, smallest seeded hashes within each class. Falls
    back to an unstratified sample when a class has one member or there are
    fewer train or test slots than classes."""
    require_classes(df, label)
    classes = class_table(df, label, id_col)
    size = classes.agg(F.sum("class_rows").alias("n"), F.count(F.lit(1)).alias("k"), F.min("class_rows").alias("least")).first()
    n, k = size["n"] or 0, size["k"]
    t = train_size if train_size is not None else min(cap, int(fraction * n))
    h = seeded_hash(seed, "split", id_col)
    if not (n and size["least"] >= 2 and t >= k and n - t >= k):
        return _smallest(df, t, h, id_col, "in_train")
    rows = df.select(named(label).alias("label"), h.alias("h"), F.col(id_col).alias("row_id"))
    cuts = class_cutoffs(rows, allocated(classes, t))        # t >= k: every class has a row
    alloc = classes.select("label", "class_rows").join(cuts.drop("class_rows"), "label", "left")
    found = join_classes(df.withColumn("__h", h), write_once(alloc, "cutoffs"), label)
    hit = (F.col("__h") < F.col("cut_hash")) | ((F.col("__h") == F.col("cut_hash")) & (F.col(id_col) <= F.col("cut_id")))
    return found.withColumn("in_train", F.coalesce(hit, F.lit(False))).select(*df.columns, "in_train")


def _class_positions(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """Adds ``__place``: 0-based position of the row within its class in the given order.
    Global positions over (label, order) minus the class's first one: no window
    partitioned by class (a class may hold a third of the table)."""
    placed = ordered_positions(df, [label, *order], out_col="__pos")
    first = write_once(placed.groupBy(named(label).alias("label")).agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("class_rows")), "first")
    return (join_classes(placed, first, label).withColumn("__place", F.col("__pos") - F.col("__first"))
            .drop("__pos", "__first"))


def stratified_rank(df: DataFrame, seed: int = 42, label: str = "label",
                    id_col: str = "row_id") -> DataFrame:
    """Adds ``class_rank``: 1-based order of the row within its class by
    (seeded hash, row id)."""
    require_classes(df, label)
    hashed = df.withColumn("__h", seeded_hash(seed, "split", id_col))
    ranked = _class_positions(hashed, ["__h", id_col], label)
    return ranked.select(*df.columns, (F.col("__place") + 1).alias("class_rank"))


def stratified_folds(df: DataFrame, k: int = 5, label: str = "label",
                     id_col: str = "row_id") -> DataFrame:
    """Adds ``fold`` of unshuffled stratified k-fold: classes in order of first
    appearance; the sorted class codes are dealt round-robin to the folds, which
    fixes how many rows of each class every fold gets; within a class, rows go to
    the folds in row order."""
    require_classes(df, label)
    classes = ordered_positions(class_table(df, label, id_col), ["first_id"], weight_col="class_rows", out_col="__before")
    placed = _class_positions(df, [id_col], label).drop("class_rows")
    dealt = join_classes(placed, write_once(classes.select("label", "class_rows", "__before"), "dealt"), label)
    upto, fold = F.lit(0), F.lit(0)
    for i in range(k):
        # rows of this class that the dealing gives to fold i
        upto = upto + F.expr(f"(__before + class_rows - {i} + {k - 1}) div {k} - (__before - {i} + {k - 1}) div {k}")
        fold = fold + (upto <= F.col("__place")).cast("int")
    return dealt.select(*df.columns, fold.alias("fold"))


def kfolds(df: DataFrame, n: int, k: int = 5, id_col: str = "row_id") -> DataFrame:
    """Unshuffled k-fold over dense positions: contiguous folds, the first
    ``n mod k`` one row larger."""
    from .partitions import chunk_assign
    return df.withColumn("fold", chunk_assign(id_col, n, k).cast("int"))
