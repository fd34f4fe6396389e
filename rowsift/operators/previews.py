"""Previews of index vectors: first k, last k, every k-th element."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def head_k(df: DataFrame, k: int, idx: str = "idx") -> DataFrame:
    """First k positions (dense index: a pushed-down range filter, no sort)."""
    return df.where(F.col(idx) < F.lit(k))


def tail_k(df: DataFrame, k: int, idx: str = "idx") -> DataFrame:
    """Last k positions: top-k by index (TakeOrderedAndProject, k rows per task)."""
    return df.orderBy(F.col(idx).desc()).limit(k)


def every_kth(df: DataFrame, k: int, idx: str = "idx") -> DataFrame:
    return df.where(F.pmod(F.col(idx), F.lit(k)) == 0)
