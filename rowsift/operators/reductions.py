"""Reductions and verification checks over index vectors.

All are single aggregates (partial + final hash aggregate); nothing but the
one-row (or per-block) result reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_total(df: DataFrame, value: str = "value") -> DataFrame:
    return df.agg(F.sum(F.col(value).cast("bigint")).alias("total"))


def all_equal(df: DataFrame, value: str = "value", idx: str = "idx") -> DataFrame:
    """Are all values equal to the first one?"""
    return df.agg((F.min(value) == F.max(value)).alias("all_equal"),
                  F.min_by(F.col(value), F.col(idx)).alias("first_value"))


def all_equal_target(df: DataFrame, target, value: str = "value", idx: str = "idx"
                     ) -> DataFrame:
    """Count of values different from ``target`` and the first such (idx, value)."""
    bad = F.col(value) != F.lit(target)
    return df.agg(F.count_if(bad).alias("n_failed"),
                  F.min(F.when(bad, F.col(idx))).alias("first_failed_idx"),
                  F.min_by(F.when(bad, F.col(value)), F.when(bad, F.col(idx)))
                  .alias("first_failed_value"))


def verify_expected(df: DataFrame, expected, value: str = "value", idx: str = "idx",
                    eps: float = 0.0) -> DataFrame:
    """Compare with an expected expression, exactly (eps=0) or within eps;
    report the count and the first mismatch (idx, expected, actual)."""
    e = expected
    bad = (F.abs(F.col(value) - e) > F.lit(eps)) if eps else (F.col(value) != e)
    return df.agg(F.count_if(bad).alias("n_mismatch"),
                  F.min(F.when(bad, F.col(idx))).alias("first_idx"),
                  F.min_by(F.when(bad, e), F.when(bad, F.col(idx))).alias("first_expected"),
                  F.min_by(F.when(bad, F.col(value)), F.when(bad, F.col(idx)))
                  .alias("first_actual"))


def residual_sample(df: DataFrame, expected, every: int = 1000, value: str = "value",
                    idx: str = "idx") -> DataFrame:
    """Value, expected value and absolute difference at every ``every``-th index."""
    return (df.where(F.pmod(F.col(idx), F.lit(every)) == 0)
            .select(idx, F.col(value).alias("value"), expected.alias("expected"),
                    F.abs(F.col(value) - expected).alias("abs_diff")))
