"""Registry of the named queries exposed through ``__spark_entry__``.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the given
tables; where the semantics are SQL-expressible, an equivalent DuckDB query is
registered under the same name with the same column names.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import q_selection  # noqa: F401
    from . import q_vectors  # noqa: F401
    from . import q_tabular  # noqa: F401
    from . import q_forest  # noqa: F401
