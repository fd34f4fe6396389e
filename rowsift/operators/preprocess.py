"""Cleaning, encoding and standardisation of a raw dataset table.

Policy (one dataset at a time):
1. drop rows with any missing value (null or NaN), over all columns;
2. numeric columns = integral, fractional and boolean types; categorical = strings (dates
   and timestamps are first rendered as strings, as they would be in a file);
3. a categorical column with 100 or more distinct values is dropped, the others
   are coded by the rank of their value in code-point order, from 0;
4. the target is the first column (in table order) whose lower-cased name is
   one of target, class, label, y, outcome, diagnosis, status;
5. every other column is standardised with the population standard deviation
   (a constant column becomes 0).

Vocabularies are
applied as literal maps, so no join touches the data.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.literals import named
from ..session import write_once

# Accepted target names and the cardinality limit.
TARGET_NAMES = ("target", "class", "label", "y", "outcome", "diagnosis", "status")
MAX_CATEGORIES = 100


class PreprocessError(ValueError):
    """The dataset cannot be prepared (empty, no target, ...)."""


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows without null or NaN in any column."""
    for f in df.schema.fields:
        present = named(f.name).isNotNull()
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            present = present & ~F.isnan(named(f.name))
        df = df.where(present)
    return df


def classify_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    num, cat = [], []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.BooleanType, T.IntegerType, T.LongType, T.ShortType, T.ByteType,
                                   T.FloatType, T.DoubleType, T.DecimalType)):
            num.append(f.name)
        elif isinstance(f.dataType, (T.StringType, T.DateType, T.TimestampType,
                                     T.TimestampNTZType)):
            cat.append(f.name)
    return num, cat


def as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Render date/timestamp categoricals as strings."""
    out = df
    for c in cols:
        if not isinstance(df.schema[c].dataType, T.StringType):
            out = out.withColumn(c, named(c).cast("string"))
    return out


def category_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, value)`` distinct pairs of the categorical columns, in one pass
    (unpivot + distinct)."""
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string")
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), named(c).cast("string").alias("value"))
        for c in cols])).alias("kv")).select("kv.column", "kv.value")
    return stacked.distinct()


def bounded_values(df: DataFrame, cols: list[str], limit: int) -> dict[str, list[tuple[str, int]]]:
    """Sorted (value, count) of every column with fewer than ``limit`` distinct values.

    Exact: a task stops collecting a column at ``limit`` values and says so (the
    column is over the limit); the others' values are merged and counted. A free-text
    column moves at most ``limit`` values of each task, and the driver gets
    fewer than ``limit`` values of each column."""
    if not cols:
        return {}
    names = list(cols)

    def collect(batches):
        seen = [Counter() for _ in names]
        for b in batches:
            for i, values in enumerate(b.columns):
                if seen[i] is not None:
                    counts = pc.value_counts(values)
                    for v, n in zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()):
                        seen[i][v] += n
                    if len(seen[i]) >= limit:
                        seen[i] = None
        rows = [(i, None, 0) if s is None else (i, v, n)
                for i, s in enumerate(seen) for v, n in ([(None, 0)] if s is None else s.items())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64())], names=["col", "value", "n"])

    text = df.select(*(named(c).cast("string").alias(f"v{i}") for i, c in enumerate(names)))
    found = write_once(text.mapInArrow(collect, "col int, value string, n long")
                       .groupBy("col", "value").agg(F.sum("n").alias("n")), "categories")
    sizes = {r.col: r.size for r in found.groupBy("col").agg(
        F.when(F.count("value") < F.count("*"), limit).otherwise(F.count("*")).alias("size")).collect()}
    kept = [i for i in range(len(names)) if sizes.get(i, 0) < limit]
    out: dict[str, list[tuple[str, int]]] = {names[i]: [] for i in kept}
    if kept:
        for r in found.filter(F.col("col").isin(kept)).collect():
            out[names[r.col]].append((r.value, int(r.n)))
    return {c: sorted(v) for c, v in out.items()}


def category_cardinality(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct count of every categorical column from a single aggregate."""
    return category_values(df, cols).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"))


def vocabulary(df: DataFrame, cols: list[str], limit: int = MAX_CATEGORIES
               ) -> tuple[dict[str, list[str]], dict[str, int]]:
    """Sorted values of the columns under the limit, and every column's number of
    distinct values, counted exactly up to ``limit`` (``limit``: that many or more)."""
    values = bounded_values(df, cols, limit)
    vocab = {c: [v for v, _ in kv] for c, kv in values.items()}
    return vocab, {c: len(vocab[c]) if c in vocab else limit for c in cols}


def encode_expr(col: str, values: list[str]):
    """Code of each value = its position in the sorted vocabulary."""
    from ..functions.literals import lookup
    return lookup({v: i for i, v in enumerate(values)}, named(col).cast("string"))


def detect_target(columns: list[str], target: str | None = None) -> str:
    if target is not None:
        if target not in columns:
            raise PreprocessError(f"target column {target!r} not in the table")
        return target
    for c in columns:
        if str(c).lower() in TARGET_NAMES:
            return c
    raise PreprocessError("no target column (target, class, label, y, outcome, diagnosis, status)")


def standardize_exprs(df: DataFrame, cols: list[str]) -> list:
    """(x - mean) / population std per column from ONE aggregate; sd 0 -> 1."""
    if not cols:
        return []
    aggs = []
    for c in cols:
        aggs += [F.avg(named(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_pop(named(c).cast("double")).alias(f"s_{c}")]
    mom = df.agg(*aggs).first()
    out = []
    for c in cols:
        m, s = mom[f"m_{c}"], mom[f"s_{c}"]
        s = 1.0 if not s else s
        out.append(((named(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c))
    return out


@dataclass
class Prepared:
    table: DataFrame                 # target column first, then the features
    target: str
    features: list[str]
    task: str = "classification"
    dropped: list[str] = field(default_factory=list)
    vocab: dict = field(default_factory=dict)
    cardinality: dict = field(default_factory=dict)
    clean: DataFrame | None = None    # the rows as read, after the missing-value drop


def preprocess(df: DataFrame, target: str | None = None, task: str | None = None,
               limit: int = MAX_CATEGORIES, assign_row_id: bool = False) -> Prepared:
    """The whole policy of the module docstring; returns the prepared table.

    Eager steps: one aggregate (row count, mean and population std per numeric
    column) and the exact bounded value counts of the categorical columns
    (:func:`bounded_values`); code moments follow from the counts.

    ``assign_row_id=True`` numbers the rows left after the missing-value drop
    densely, in their current (file) order, as column ``row_id`` (the positions
    the search works on); it is carried along and is not a feature.
    """
    from .rowid import with_row_id
    if df is None:
        raise PreprocessError("no table")
    clean = drop_missing(df)
    ids = []
    num, cat = classify_columns(clean)
    clean = as_text(clean, cat)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(num):
        aggs += [F.avg(named(c).cast("double")).alias(f"m{i}"),
                 F.stddev_pop(named(c).cast("double")).alias(f"s{i}")]
    st = clean.agg(*aggs).first()
    n = int(st["__n"])
    if n == 0:
        raise PreprocessError("empty table" if df.isEmpty() else "no row without missing values")
    values = bounded_values(clean, cat, limit)
    vocab = {c: [v for v, _ in kv] for c, kv in values.items()}
    freq = {c: [k for _, k in kv] for c, kv in values.items()}
    card = {c: len(vocab[c]) if c in vocab else limit for c in cat}
    dropped = [c for c in cat if card.get(c, 0) >= limit]
    if assign_row_id:
        clean = with_row_id(clean)
        ids = ["row_id"]
    kept = [c for c in clean.columns if c not in dropped and c not in ids]
    tgt = detect_target(kept, target)
    feats = [c for c in kept if c != tgt and (c in num or c in vocab)]
    moments = {}
    for c in feats:
        if c in vocab:
            mean = sum(i * k for i, k in enumerate(freq[c])) / n
            var = sum(k * (i - mean) ** 2 for i, k in enumerate(freq[c])) / n
            moments[c] = (mean, var ** 0.5)
        else:
            moments[c] = (st[f"m{num.index(c)}"], st[f"s{num.index(c)}"])

    def col_expr(c):
        x = encode_expr(c, vocab[c]).cast("int") if c in vocab else named(c)
        if c == tgt:
            return (x.cast("int") if isinstance(clean.schema[c].dataType, T.BooleanType) else x).alias(c)
        m, sd = moments[c]
        sd = 1.0 if not sd else sd
        return ((x.cast("double") - F.lit(m)) / F.lit(sd)).alias(c)
    table = clean.select(*ids, col_expr(tgt), *[col_expr(c) for c in feats])
    return Prepared(table, tgt, feats, task or "classification", dropped, vocab, card, clean)


def to_model_table(prep: Prepared, row_id: str = "row_id") -> DataFrame:
    """``(row_id, label, features array<double>)`` for the row-selection search;
    the table must already carry a dense ``row_id``."""
    return prep.table.select(named(row_id), named(prep.target).alias("label"),
                             F.array(*[named(c) for c in prep.features]).alias("features"))
