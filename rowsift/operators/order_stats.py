"""Exact per-group order statistics without sorting the groups.

``row_number() OVER (PARTITION BY g ORDER BY h, id) <= k`` puts every group in
one task; with one group holding a third of the table that task never ends.
Here the cut-off of the k smallest ``(h, id)`` per group is found by radix
refinement on the 60-bit hash ``h``: each level is a narrow scan feeding a
partial (map-side combined) aggregate of ``(group, bucket) -> count``, whose
output is bounded by ``groups * 2**bits_per_level`` rows regardless of the table
size. Once the rows that can still hold the cut-off are few (``collect_limit``),
they are fetched and the exact cut-off is read off. The result is identical to
the window formulation; tests check that against DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bits import HASH_BITS
from ..functions.literals import in_set, lookup

ALL = None  # cut-off meaning "every row of the group qualifies"


def _lookup(mapping: dict, key_col, default):
    return lookup(mapping, key_col, default)


def smallest_k_cutoffs(df: DataFrame, k_by_group: dict[int, int], *, group_col: str = "grp",
                       order_col: str = "h", id_col: str = "row_id",
                       bits_per_level: int = 8, collect_limit: int = 200_000,
                       first_level: dict | None = None) -> dict:
    """For each group g, the ``(h, id)`` of its ``k_by_group[g]``-th smallest row.

    ``df`` holds ``group_col`` (bigint), ``order_col`` (60-bit non-negative
    bigint) and ``id_col`` (unique per group). Returns ``{g: (h, id)}``; groups
    with no more than k rows map to ``ALL``; groups with k <= 0 are omitted.
    ``first_level`` may carry the histogram of the top ``bits_per_level`` hash
    bits per group (``{g: [(bucket, count), ...]}``) when an earlier aggregate
    already produced it; the first scan is then skipped.
    """
    want = {g: k for g, k in k_by_group.items() if k > 0}
    cut: dict = {}
    if not want:
        return cut
    g = F.col(group_col)
    h = F.col(order_col)
    prefix = {gr: 0 for gr in want}          # fixed high bits of the cut-off
    need = dict(want)                         # rank still to find below prefix
    shift = HASH_BITS                         # number of free low bits
    first = True
    while need:
        active = list(need)
        in_prefix = (F.shiftright(h, shift) == _lookup(prefix, g, -1)) if shift < HASH_BITS \
            else F.lit(True)
        scope = df.where(in_set(active, g) & in_prefix)
        if not first:
            total = sum(prev_counts[gr] for gr in active)
            if total <= collect_limit:
                rows = scope.select(g.alias("g"), h.alias("h"), F.col(id_col).alias("i")).collect()
                by = {}
                for r in rows:
                    by.setdefault(r["g"], []).append((r["h"], r["i"]))
                for gr in active:
                    lst = sorted(by.get(gr, []))
                    cut[gr] = lst[need[gr] - 1]
                break
        step = min(bits_per_level, shift)
        shift -= step
        bucket = F.shiftright(h, shift).bitwiseAND(F.lit((1 << step) - 1))
        if first and first_level is not None:
            per = first_level
        else:
            agg = scope.groupBy(g.alias("g"), bucket.alias("b")).count().collect()
            per = {}
            for r in agg:
                per.setdefault(r["g"], []).append((r["b"], r["count"]))
        prev_counts = {}
        for gr in active:
            buckets = sorted(per.get(gr, []))
            if first and sum(c for _, c in buckets) <= need[gr]:
                cut[gr] = ALL
                del need[gr]
                continue
            run = 0
            for b, c in buckets:
                if run + c >= need[gr]:
                    need[gr] -= run
                    prefix[gr] = (prefix[gr] << step) | b
                    prev_counts[gr] = c
                    break
                run += c
        first = False
        if shift == 0:
            # full hash fixed: the remaining rows share h, the id decides
            for gr in list(need):
                rows = df.where((g == gr) & (h == prefix[gr])).select(id_col).collect()
                ids = sorted(r[0] for r in rows)
                cut[gr] = (prefix[gr], ids[need[gr] - 1])
            break
    return cut


def within_cutoff(cut: dict, *, group_col: str = "grp", order_col: str = "h",
                  id_col: str = "row_id"):
    """Predicate: the row is among the k smallest of its group."""
    g = F.col(group_col)
    all_groups = [gr for gr, c in cut.items() if c is ALL]
    bounded = {gr: c for gr, c in cut.items() if c is not ALL}
    cond = in_set(all_groups, g)
    if bounded:
        ch = _lookup({gr: c[0] for gr, c in bounded.items()}, g, -1)
        ci = _lookup({gr: c[1] for gr, c in bounded.items()}, g, -1)
        h, i = F.col(order_col), F.col(id_col)
        cond = cond | (in_set(bounded, g) & ((h < ch) | ((h == ch) & (i <= ci))))
    return cond

