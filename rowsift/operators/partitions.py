"""Assignment of dense positions to workers: chunks, blocks, cycles, grids.

All are arithmetic on a dense 0-based index, so no window is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_assign(idx: str, n: int, workers: int) -> Column:
    """Contiguous chunks, the first ``n mod workers`` one item larger (the
    sizes of ``numpy.array_split``)."""
    q, r = divmod(n, workers)
    i = F.col(idx)
    big = F.lit(r * (q + 1))
    head = F.expr(f"`{idx}` div {q + 1}")
    tail = F.lit(r) + F.expr(f"(`{idx}` - {r * (q + 1)}) div {max(q, 1)}")
    return F.when(i < big, head).otherwise(tail).cast("bigint")


def block_partition(idx: str, n: int, parts: int) -> Column:
    """Contiguous regular blocks: ``floor(idx * parts / n)``."""
    return F.expr(f"(`{idx}` * {int(parts)}) div {int(n)}")


def cyclic_partition(idx: str, parts: int) -> Column:
    """Round-robin (grid-stride) lane: ``idx mod parts``."""
    return F.pmod(F.col(idx), F.lit(parts))


def ceil_div(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else F.lit(a) if isinstance(a, int) else a
    b = F.col(b) if isinstance(b, str) else F.lit(b) if isinstance(b, int) else b
    return F.call_function("div", a + b - F.lit(1), b)      # integer division, exact beyond 2^53
