"""Text renderings of vectors (the programs' printed lines), as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def format_equation(a, b, r) -> Column:
    """``"a * b = r"`` for integers."""
    return F.format_string("%d * %d = %d", a, b, r)


def format_indexed(name: str, idx, v, fmt: str = "%d") -> Column:
    """``"V[i] = x"``."""
    return F.format_string(f"{name}[%d] = {fmt}", idx, v)


def rows_of(df: DataFrame, per_line: int = 10, idx: str = "idx", value: str = "value"
            ) -> DataFrame:
    """Values joined by blanks, ``per_line`` consecutive positions per line.
    Groups are bounded (``per_line`` rows), so the collect per group is small."""
    line = F.floor(F.col(idx) / F.lit(per_line)).cast("bigint")
    items = F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"),
                                                 F.col(value).cast("string").alias("s"))))
    return df.groupBy(line.alias("line")).agg(
        F.array_join(F.transform(items, lambda x: x["s"]), " ").alias("text"))
