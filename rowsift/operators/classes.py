"""Per-class numbers as distributed tables: no limit on the number of classes.

A target may have any number of distinct values. Counts, allocations and offsets of the classes
stay tables with one row per class; they meet the rows in a join on the label. That join is a
broadcast while the table has at most ``BROADCAST_CLASSES`` rows (counted first); beyond that the classes
that hold more than 1 in ``HEAVY`` rows (at most ``HEAVY`` of them) are broadcast
and the others shuffled, so that no task gets a hot class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bits import HASH_RANGE
from ..functions.literals import named
from ..session import write_once
from .rowid import ordered_positions

BROADCAST_CLASSES = 100_000
HEAVY = 1000


class ContinuousTarget(TypeError):
    """Classes are asked for, but the target is a fractional number."""


def require_classes(df: DataFrame, label: str = "label") -> None:
    """Classes may be of any type and number, but not fractional numbers (whole-numbered
    doubles pass)."""
    kind = df.schema[label].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        y = named(label)
        if not df.where(y != F.floor(y)).limit(1).isEmpty():
            raise ContinuousTarget(f"column {label} holds fractional numbers: the target is continuous")


def class_table(df: DataFrame, label: str = "label", id_col: str = "row_id") -> DataFrame:
    """Written table (label, class_rows, first_id): rows and smallest id of every class."""
    return write_once(df.groupBy(named(label).alias("label")).agg(
        F.count(F.lit(1)).alias("class_rows"), F.min(id_col).alias("first_id")), "classes")


def join_classes(df: DataFrame, classes: DataFrame, label: str = "label",
                 broadcast_classes: int = BROADCAST_CLASSES) -> DataFrame:
    """``df`` with the columns of ``classes`` (a written table keyed by ``label``, with
    ``class_rows``); rows of absent classes go."""
    right = classes.withColumnRenamed("label", "__class")
    same = named(label) == F.col("__class")
    size = classes.agg(F.count(F.lit(1)).alias("k"), F.sum("class_rows").alias("n")).first()
    if size["k"] <= broadcast_classes:
        return df.join(F.broadcast(right), same).drop("__class")
    hot = F.col("class_rows") * HEAVY > size["n"]
    heavy = F.broadcast(right.where(hot))
    split = df.join(heavy.select(F.col("__class"), F.lit(True).alias("__hot")), same, "left").drop("__class")
    return (split.where("__hot").drop("__hot").join(heavy, same)
            .unionByName(split.where("__hot IS NULL").drop("__hot").join(right.where(~hot), same)).drop("__class"))


def allocated(classes: DataFrame, total: int) -> DataFrame:
    """Adds ``alloc``: ``total`` split over the classes in proportion to their rows; leftover
    units go to the largest fractional parts, ties to the smallest label."""
    n = classes.agg(F.sum("class_rows")).first()[0]
    product = F.col("class_rows").cast("decimal(19,0)") * F.lit(total).cast("decimal(19,0)")
    shares = write_once(classes.withColumn("rest", (product % F.lit(n).cast("decimal(19,0)")).cast("bigint"))
                        .withColumn("alloc", ((product - F.col("rest")) / F.lit(n).cast("decimal(19,0)")).cast("bigint")), "shares")
    left = total - (shares.agg(F.sum("alloc")).first()[0] or 0)
    ranked = ordered_positions(shares.withColumn("__rest", -F.col("rest")), ["__rest", "label"], out_col="__place")
    return ranked.select(*classes.columns, (F.col("alloc") + (F.col("__place") < left).cast("bigint")).alias("alloc"))


def likely_threshold(k: Column, n: Column, slack: float = 1.0) -> Column:
    """A hash below which, of ``n`` uniform ones, at least ``k`` lie almost surely (and few more)."""
    wanted = k + (6.0 * F.sqrt(k) + 12.0) * slack
    return F.when(wanted >= n, F.lit(HASH_RANGE)).otherwise((wanted / n * float(HASH_RANGE)).cast("bigint"))


def class_cutoffs(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(label, class_rows, cut_hash, cut_id) of the ``alloc`` smallest (h, row_id) of every class with
    ``alloc`` > 0. ``rows`` holds (label, h, row_id) with 60-bit seeded hashes.

    Only rows below a class's likely threshold are sorted: about as many as are taken, not the
    table. A class that has too few of them is asked again with a wider one."""
    todo, out, slack = write_once(classes.where("alloc > 0"), "wanted"), None, 1.0
    while True:
        limits = todo.withColumn("limit", likely_threshold(F.col("alloc"), F.col("class_rows"), slack))
        near = write_once(join_classes(rows, limits).where("h < limit").select("label", "h", "row_id", "alloc", "class_rows"), "near")
        placed = ordered_positions(near, ["label", "h", "row_id"], out_col="__pos")
        first = write_once(placed.groupBy("label").agg(F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("class_rows")), "first")
        ranked = join_classes(placed.drop("class_rows"), first.withColumnRenamed("class_rows", "__near").withColumn("class_rows", F.col("__near")))
        cut = (ranked.where(F.col("__pos") - F.col("__first") + 1 == F.col("alloc"))
               .select("label", F.col("h").alias("cut_hash"), F.col("row_id").alias("cut_id")))
        cut = write_once(todo.select("label", "class_rows").join(cut, "label"), "cut")
        out = cut if out is None else out.unionByName(cut)
        rest = todo.join(cut.select("label"), "label", "left_anti")
        if rest.isEmpty():
            return out
        todo, slack = write_once(rest, "wanted"), slack * 16
