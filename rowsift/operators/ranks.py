"""Ranks, sortedness and sorting of index vectors, without global windows.

``rank() OVER (ORDER BY v)`` over a whole table is a single task. The rank of a
value is the number of strictly smaller values, so it is computed from the
distinct values and their counts (map-side combined aggregate), a running sum
over them (:func:`ordered_positions`, per-partition offsets) and an equi-join
back on the value.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .rowid import ordered_positions


def rank_positions(df: DataFrame, value: str = "value", out_col: str = "position") -> DataFrame:
    """0-based position = count of strictly smaller values; ties share it."""
    return df.join(_starts(df, value, out_col), on=value, how="inner")


def _starts(df: DataFrame, value: str, out_col: str) -> DataFrame:
    """``(value, out_col)`` per distinct value: how many elements are smaller."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__cnt"))
    return ordered_positions(counts, [value], out_col=out_col, weight_col="__cnt").select(value, out_col)


def count_smaller(df: DataFrame, value: str = "value") -> DataFrame:
    """For each element, the number of strictly smaller elements."""
    return rank_positions(df, value, out_col="n_smaller")


def rank_sort(df: DataFrame, value: str = "value", idx: str = "idx") -> DataFrame:
    """Sorted order with ties kept: position = row number in (value, idx) order."""
    return ordered_positions(df, [value, idx], out_col="position")


def scatter_by_position(df: DataFrame, n: int, value: str = "value") -> DataFrame:
    """``out[p] = v`` with p the count of smaller values over a zero-filled
    output of n slots; equal values land on the same slot, so the slots after
    it stay 0 (the counting-sort collision)."""
    spark = df.sparkSession
    placed = _starts(df, value, "slot").select("slot", F.col(value).alias("v"))
    slots = spark.range(n).withColumnRenamed("id", "slot")
    return slots.join(placed, on="slot", how="left").select(
        "slot", F.coalesce(F.col("v"), F.lit(0)).alias(value))


def is_sorted(df: DataFrame, value: str = "value", idx: str = "idx") -> DataFrame:
    """No i with v[i-1] > v[i]: one range partitioning on idx, neighbours compared
    inside the partitions, then the partitions' edges (one row each) in order."""
    ranged = df.select(idx, value).repartitionByRange(idx).sortWithinPartitions(idx)
    kind = df.schema[value].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        bad = 0
        for b in batches:
            v = b.column(1)
            if not len(v):
                continue
            if first is None:
                first = v[:1]
            else:
                bad += bool(pc.greater(last, v[0]).as_py())
            bad += pc.sum(pc.greater(v[:-1], v[1:])).as_py() or 0
            last = v[-1]
        if first is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()]), first, pa.array([last.as_py()], first.type),
                 pa.array([int(bad)])], names=["part", "first", "last", "bad"])

    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("first", kind),
                           T.StructField("last", kind), T.StructField("bad", T.LongType())])
    edges = sorted(ranged.mapInArrow(scan, schema).collect(), key=lambda r: r["part"])
    n = sum(r["bad"] for r in edges) + sum(
        a["last"] is not None and b["first"] is not None and a["last"] > b["first"] for a, b in zip(edges, edges[1:]))
    return df.sparkSession.createDataFrame([(n == 0, int(n))], "is_sorted boolean, n_inversions long")
