"""Literal lookup tables built as one SQL expression.

``create_map(lit(k1), lit(v1), ...)`` costs one driver-to-JVM call per entry;
a ``map_from_arrays`` parsed from text costs one call whatever the size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(column: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return f"{v}L"
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def map_literal(mapping: dict) -> Column:
    keys = ", ".join(sql_literal(k) for k in mapping)
    vals = ", ".join(sql_literal(v) for v in mapping.values())
    return F.expr(f"map_from_arrays(array({keys}), array({vals}))")


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """``mapping[key]`` (``default`` when absent) as a Column."""
    if not mapping:
        return F.lit(default)
    got = F.element_at(map_literal(mapping), key)
    return got if default is None else F.coalesce(got, F.lit(default))


def in_set(values, col: Column) -> Column:
    vals = list(values)
    if not vals:
        return F.lit(False)
    return col.isin(vals)      # a hash set from eleven values on
