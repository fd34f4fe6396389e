"""Dense positions (0..n-1) and running sums without a global window.

``row_number() OVER (ORDER BY ...)`` without PARTITION BY runs in one task. Here
the table is range-partitioned on the order keys (the sample-based bounds split
even a hot key range over many partitions) and written once to the shared
checkpoint folder together with each row's partition number and its local
position or running sum. Everything after that reads this written table, so ids
do not depend on a cache, a re-sampled range partitioning or a lost executor.
The per-partition totals (one number per partition) become an array of offsets,
indexed by the partition number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import write_once

LOCAL_BITS = 33        # monotonically_increasing_id(): partition << 33 | place


def _running(weight_col: str):
    """Adds the running sum of ``weight_col`` within the partition, in row order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            w = np.asarray(b.column(weight_col), dtype=np.int64)
            sums = np.cumsum(w) + total
            total = int(sums[-1]) if len(sums) else total
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sums)], names=[*b.schema.names, "__sum"])
    return run


def ordered_positions(df: DataFrame, order_cols: list[str], *, out_col: str = "row_id",
                      weight_col: str | None = None, exclusive: bool = True,
                      num_partitions: int | None = None, keep_partitioning: bool = False
                      ) -> DataFrame:
    """Add ``out_col`` = sum of ``weight_col`` (default 1) over the rows that come
    before this row in the order ``order_cols`` (plus this row if not
    ``exclusive``). The order must be total, e.g. end with a unique key.

    ``keep_partitioning=True`` keeps the current partition order instead of
    range partitioning (e.g. file order of a freshly read delimited file).
    """
    spark = df.sparkSession
    if keep_partitioning:
        ranged = df
    else:
        n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranged = df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
    ranged = ranged.withColumn("__mid", F.monotonically_increasing_id())
    if weight_col:
        ranged = ranged.withColumn("__w", F.col(weight_col).cast("bigint"))
        ranged = ranged.mapInArrow(_running("__w"), T.StructType(
            [*ranged.schema.fields, T.StructField("__sum", T.LongType())]))
        local = F.col("__sum")
    else:
        local = F.col("__mid").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1)) + 1
    fixed = write_once(ranged, "positions")
    part = F.shiftright("__mid", LOCAL_BITS).cast("int")
    totals = {r["p"]: int(r["t"]) for r in fixed.groupBy(part.alias("p")).agg(F.max(local).alias("t")).collect()}
    offsets, before = [], 0
    for p in range(max(totals, default=-1) + 1):
        offsets.append(before)
        before += totals.get(p, 0)
    if not offsets:
        return fixed.withColumn(out_col, F.lit(0).cast("bigint")).drop("__mid", "__w", "__sum")
    offset = F.expr("array(" + ", ".join(f"{x}L" for x in offsets) + ")")
    position = local + offset[part]
    if exclusive:
        position = position - (F.col("__w") if weight_col else F.lit(1))
    return fixed.withColumn(out_col, position.cast("bigint")).drop("__mid", "__w", "__sum")


def with_row_id(df: DataFrame, order_cols: list[str] | None = None, out_col: str = "row_id"
                ) -> DataFrame:
    """Dense 0-based row ids: in ``order_cols`` order, or in the current
    (file) order when no order is given."""
    if order_cols:
        return ordered_positions(df, order_cols, out_col=out_col)
    return ordered_positions(df, [], out_col=out_col, keep_partitioning=True)
