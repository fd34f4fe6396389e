"""Element-wise operators over index-aligned vectors.

A vector is a table ``(idx bigint, value)``; several aligned vectors are
several columns of one table (cheapest: no join at all) or separate tables
aligned with :func:`zip_join`. Every operator is a Column expression, so a
chain of them fuses into one whole-stage-codegen projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gen_index(spark, n: int, idx: str = "idx") -> DataFrame:
    """Positions 0..n-1 (the launch geometry of a 1-D grid)."""
    return spark.range(n).withColumnRenamed("id", idx)


def const(value) -> Column:
    return F.lit(value)


def ramp(idx="idx") -> Column:
    return _c(idx)


def ramp_desc(n: int, idx="idx") -> Column:
    return F.lit(n - 1) - _c(idx)


def affine(start, step, idx="idx") -> Column:
    return F.lit(start) + F.lit(step) * _c(idx)


def add_index(v, idx="idx") -> Column:
    return _c(v) + _c(idx)


def add(a, b) -> Column:
    return _c(a) + _c(b)


def mul(a, b) -> Column:
    return _c(a) * _c(b)


def square(v) -> Column:
    """v*v; integers are widened to 64 bits first (ANSI mode raises on overflow)."""
    return _c(v) * _c(v)


def parity_power(v, idx="idx") -> Column:
    """Even positions squared, odd positions cubed."""
    x = _c(v)
    return F.when(F.pmod(_c(idx), F.lit(2)) == 0, x * x).otherwise(x * x * x)


def lincomb2(a, b, k1, k2) -> Column:
    return F.lit(k1) * _c(a) + F.lit(k2) * _c(b)


def lincomb3(a, b, c, k1, k2) -> Column:
    return F.lit(k1) * _c(a) + F.lit(k2) * (_c(b) + _c(c))


def scaled_expr(x, y, z, k, j, g, h) -> Column:
    """x/k - y*j*g + z*g*h (data-parallel form: one projection)."""
    return (F.try_divide(_c(x), F.lit(k)) - _c(y) * F.lit(j) * F.lit(g)
            + _c(z) * F.lit(g) * F.lit(h))


def scaled_expr_tasks(xs: DataFrame, ys: DataFrame, zs: DataFrame, k, j, g, h,
                      idx: str = "idx", value: str = "value") -> DataFrame:
    """Task-parallel form: each term is its own job over its own vector, the
    three term tables are then aligned and summed."""
    t1 = xs.select(idx, F.try_divide(F.col(value), F.lit(k)).alias("t1"))
    t2 = ys.select(idx, (F.col(value) * F.lit(j) * F.lit(g)).alias("t2"))
    t3 = zs.select(idx, (F.col(value) * F.lit(g) * F.lit(h)).alias("t3"))
    return zip_join([t1, t2, t3], idx).select(idx, (F.col("t1") - F.col("t2") + F.col("t3"))
                                              .alias("v"))


def covered(expr, covered_n: int, idx="idx") -> Column:
    """Only the first ``covered_n`` positions are computed, the rest stay 0."""
    return F.when(_c(idx) < F.lit(covered_n), expr).otherwise(F.lit(0))


def zip_join(frames: list[DataFrame], idx: str = "idx") -> DataFrame:
    """Positional alignment of vectors stored in separate tables: an equi-join
    on the dense index (Catalyst picks sort-merge or broadcast by size). The
    vectors must be equally long: a position that one of them lacks fails the
    job that reads it instead of being dropped."""
    def pair(a: DataFrame, b: DataFrame) -> DataFrame:
        left = a.withColumn("__a", F.lit(True))
        right = b.withColumn("__b", F.lit(True))
        both = left.join(right, on=idx, how="full")
        complete = F.col("__a").isNotNull() & F.col("__b").isNotNull()
        return (both.withColumn(idx, F.when(complete, F.col(idx)).otherwise(
            F.raise_error(F.concat(F.lit("vectors differ in length at position "), F.col(idx)))))
            .drop("__a", "__b"))
    return reduce(pair, frames)


def filter_even(df: DataFrame, idx: str = "idx") -> DataFrame:
    return df.where(F.pmod(F.col(idx), F.lit(2)) == 0)
