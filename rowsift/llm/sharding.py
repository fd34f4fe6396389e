"""Sharding: minimax contiguous partition of atomic groups.

Documents with equal texts form one atomic group. Groups are ordered by a
60-bit prefix of the text's md5 (groups that share it count as one group). The
ordered groups are cut into contiguous shards with the smallest capacity
(largest shard) that is feasible: binary search over the capacity, each
candidate checked by greedy filling, and the cuts taken where the greedy filling
at that capacity cuts.

A group larger than an even share gets a shard of its own, in which no other
group can follow; the others are cut over the remaining shards, so one hot text
does not empty the shards behind it.

Scale: the driver never sees all groups. It holds a staircase of key ranges
with their byte sums; ranges in which some capacity that is still possible
could cut are refined (256 sub-ranges per step, one aggregate over the narrow
key table) until every range where a cut can fall is a single group. Treating a
range as one block gives an upper bound of the capacity, treating it as
divisible a lower bound; every cut lies between the two greedy fillings. Sums
are combined on the map side.

The slots are numbered by input split (offset per split and shard plus the
place within the split), never by a sort of a whole shard.

Defined cases: null text has no bytes (size 1) and shares the group of the empty text; null ids
are kept; repeated rows stay together; shards may be empty when there
are fewer groups than shards; an empty table gives an empty result; other
columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, stored, table

KEY_BITS = 60
FIRST_BITS = 12
STEP_BITS = 8


class Range:
    """Groups with ``key >> shift == prefix``; ``single`` if it is one group."""

    __slots__ = ("prefix", "shift", "size", "single", "last")

    def __init__(self, prefix: int, shift: int, size: int, single: bool, last: int):
        self.prefix, self.shift, self.size, self.single, self.last = prefix, shift, size, single, last


def greedy(ends: Sequence[int], capacity: int, shards: int, fluid: Sequence[bool] | None = None
           ) -> tuple[list[tuple[int, int]], bool]:
    """Fill shard after shard up to ``capacity``. ``ends``: running byte sums of
    the blocks. Returns for each cut (block index, position in bytes) and
    whether everything fits. Blocks marked fluid may be cut inside."""
    cuts, pos, total = [], 0, ends[-1] if ends else 0
    for _ in range(shards - 1):
        at = bisect_right(ends, pos + capacity)
        whole = ends[at - 1] if at else 0
        if fluid and at < len(ends) and fluid[at]:
            pos = max(whole, pos + capacity)
        else:
            pos = max(whole, pos)
        cuts.append((at, min(pos, total)))
    return cuts, total - pos <= capacity


def smallest(ends: Sequence[int], shards: int, low: int, high: int,
             fluid: Sequence[bool] | None = None) -> int:
    """Smallest feasible capacity in [low, high] by binary search."""
    while low < high:
        mid = (low + high) // 2
        if greedy(ends, mid, shards, fluid)[1]:
            high = mid
        else:
            low = mid + 1
    return low


def cut_keys(ranges: list[Range], shards: int,
             refine: Callable[[list[Range]], list[Range]]) -> tuple[list[int], int]:
    """Last key of every shard but the last one, and the capacity.

    ``refine`` replaces ranges by their sub-ranges (one distributed aggregate)."""
    while True:
        ends, pos = [], 0
        for r in ranges:
            pos += r.size
            ends.append(pos)
        if not ranges:
            return [], 0
        fluid = [not r.single for r in ranges]
        floor = max([-(-pos // shards), *(r.size for r in ranges if r.single)])
        high = smallest(ends, shards, floor, max(pos, 1))
        low = smallest(ends, shards, floor, high, fluid)
        left, _ = greedy(ends, low, shards)
        right, _ = greedy(ends, high, shards, fluid)
        open_ranges = set()
        for (a, _), (b, _) in zip(left, right):
            open_ranges.update(i for i in range(a, min(b + 1, len(ranges))) if not ranges[i].single)
        if not open_ranges:
            cuts, _ = greedy(ends, high, shards)
            return [ranges[at - 1].last if at else -1 for at, _ in cuts], high
        finer = refine([ranges[i] for i in sorted(open_ranges)])
        ranges = sorted([r for i, r in enumerate(ranges) if i not in open_ranges] + finer,
                        key=lambda r: r.prefix << r.shift)


def assign_shards(docs: DataFrame, shards: int = 16, text_col: str = "text", id_col: str = "doc_id",
                  carry: Sequence[str] = ()) -> DataFrame:
    """(id, size, text_crc32, shard, slot) and the columns named in ``carry``."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    names = [f"c{i}" for i in range(len(carry))]
    base = stored(docs.select(
        quoted(id_col).alias("id"), *(quoted(c).alias(n) for c, n in zip(carry, names)),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
        F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long").alias("key"),
        F.monotonically_increasing_id().alias("row")), "shard-keys")

    total = base.agg(F.sum("size")).first()[0] or 0
    share = total // (8 * shards)  # at most 8 * shards groups are larger
    large = [(r.key, r.size) for r in base.groupBy("key").agg(F.sum("size").alias("size"))
             .filter(F.col("size") > share).collect()] if total else []
    alone: list[int] = []
    rest = total
    for key, size in sorted(large, key=lambda x: (-x[1], x[0])):
        if len(alone) < shards - 1 and size * (shards - len(alone)) > rest:
            alone.append(key)
            rest -= size
    others = base.filter(~F.col("key").isin(alone)) if alone else base

    def ranges(df: DataFrame, shift: int) -> list[Range]:
        rows = (df.groupBy(F.shiftright("key", shift).alias("prefix"))
                .agg(F.sum("size").alias("size"), F.min("key").alias("a"), F.max("key").alias("b"))
                .collect())
        return sorted((Range(r.prefix, shift, r["size"], r.a == r.b, r.b) for r in rows),
                      key=lambda r: r.prefix)

    def refine(wide: list[Range]) -> list[Range]:
        out = []
        for shift in {r.shift for r in wide}:
            prefixes = [r.prefix for r in wide if r.shift == shift]
            out += ranges(others.filter(F.shiftright("key", shift).isin(prefixes)),
                          max(0, shift - STEP_BITS))
        return out

    cuts, _ = cut_keys(ranges(others, KEY_BITS - FIRST_BITS), shards - len(alone), refine)
    shard = sum((F.when(F.col("key") > c, 1).otherwise(0) for c in cuts), F.lit(0))
    for i, key in enumerate(alone):
        shard = F.when(F.col("key") == key, shards - 1 - i).otherwise(shard)
    placed = base.withColumn("shard", shard.cast("int")).withColumn("split", F.shiftright("row", 33))
    before = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("split", "shard").agg(F.count("*").alias("n"))
               .select("split", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    place = F.row_number().over(Window.partitionBy("split", "shard").orderBy("row")) - 1
    return (placed.withColumn("place", place).join(offsets, ["split", "shard"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("first") + F.col("place")).cast("long").alias("slot"),
                    *(F.col(n).alias(c) for c, n in zip(carry, names))))


def write_shards(docs: DataFrame, path: str, shards: int = 16, text_col: str = "text",
                 id_col: str = "doc_id") -> None:
    """Shard files: one folder per shard under ``path`` with id, slot and text."""
    (assign_shards(docs, shards, text_col, id_col, carry=[text_col])
     .select("shard", "slot", quoted(id_col), quoted(text_col))
     .write.partitionBy("shard").parquet(path))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = assign_shards(table(spark, sf_dir, "documents"), 16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op3_sharding": op3_sharding}
