"""Delimited-file datasets: discovery, delimiter choice, typed scan, sink.

Discovery lists ``*.csv``, ``*.data`` and ``*.txt`` (case-sensitive) under a
folder, recursively, from file-system metadata. The delimiter is chosen from
``,`` ``;`` tab and whitespace with one aggregate over the lines: a candidate
fails when a later line has more fields than the wider of the first two lines
(the rule of the usual C CSV reader), when the first data line is wider than
the header (the reader would take its first field as an index), when the file
is empty, or, unless ``accept_single_column``, when it yields one column. The
scan reads strings, maps the usual missing-value tokens to null and infers
bigint/double/string per column with one aggregate of ``try_cast`` counts.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.literals import named

# Accepted suffixes, candidate delimiters and missing-value tokens.
SUFFIXES = ("csv", "data", "txt")
CANDIDATES = (",", ";", "\t", "whitespace")
MISSING_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                  "nan", "null")


class LoadError(ValueError):
    """No delimiter candidate could read the file."""


def list_datasets(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, length)`` of every dataset file under ``folder``, recursively.

    A metadata listing through the Hadoop FileSystem of the path (local, HDFS,
    object stores alike); contents are not read, and empty files are listed so
    that the batch can report them.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    it = fs.listFiles(root, True)
    rows = []
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if any(name.endswith("." + sfx) for sfx in SUFFIXES):
            rows.append((st.getPath().toString(), int(st.getLen())))
    return spark.createDataFrame(rows, "path string, length bigint")


# A quoted field, or one that goes on in the next line.
QUOTED = r'"(?:[^"]|"")*(?:"|$)'
# Numbers as a CSV reader takes them: no Java type suffixes such as 1d or 2f.
NUMBER = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"


def _fields(value, cand: str):
    if cand == "whitespace":
        return F.size(F.split(F.trim(value), r"\s+"))
    return F.size(F.split(F.regexp_replace(value, QUOTED, "q"), re.escape(cand)))


def sniff_delimiter(spark: SparkSession, path: str, accept_single_column: bool = False
                    ) -> tuple[str, bool]:
    """``(delimiter, has_header)``; raises :class:`LoadError` when none fits."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    head = [r["value"] for r in lines.limit(2).collect()]
    if not head:
        raise LoadError(f"{path}: empty file")
    stats = lines.agg(*[F.max(_fields(F.col("value"), c)).alias(f"m{i}")
                        for i, c in enumerate(CANDIDATES)]).first()
    for i, cand in enumerate(CANDIDATES):
        if cand == "whitespace":
            n = [len(x.split()) for x in head]
        else:
            n = [len(re.sub(QUOTED, "q", x).split(cand)) for x in head]
        expected = max(n)
        if len(n) > 1 and n[1] > n[0] and cand != "whitespace":
            continue
        if stats[f"m{i}"] > expected:
            continue
        if expected < 2 and not accept_single_column:
            continue
        return cand, cand != "whitespace"
    raise LoadError(f"{path}: no delimiter fits")


def _typed(df: DataFrame) -> DataFrame:
    """Missing tokens -> null, then bigint / double / string per column from one
    aggregate counting values and successful casts. Text keeps its blanks."""
    cols = df.columns

    def missing(c):
        return named(c).isin(list(MISSING_TOKENS)) | (F.trim(named(c)) == "")

    nulls = df.select(*[F.when(~missing(c), named(c)).alias(c) for c in cols])

    def number(c, kind):
        return F.when(named(c).rlike(NUMBER), F.trim(named(c)).try_cast(kind))

    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(named(c)).alias(f"n{i}"), F.count(number(c, "bigint")).alias(f"i{i}"),
                 F.count(number(c, "double")).alias(f"d{i}")]
    st = nulls.agg(*aggs).first()
    out = []
    for i, c in enumerate(cols):
        n = st[f"n{i}"]
        if n and st[f"i{i}"] == n:
            out.append(number(c, "bigint").alias(c))
        elif n and st[f"d{i}"] == n:
            out.append(number(c, "double").alias(c))
        else:
            out.append(named(c))
    return nulls.select(*out)


def scan_delimited(spark: SparkSession, path: str, sep: str | None = None,
                   header: bool | None = None, accept_single_column: bool = False) -> DataFrame:
    """Typed table of a delimited file (delimiter sniffed when not given)."""
    if sep is None:
        sep, header = sniff_delimiter(spark, path, accept_single_column)
    if sep == "whitespace":
        parts = F.split(F.trim(F.col("value")), r"\s+")
        lines = spark.read.text(path).where(F.trim("value") != "")
        width = lines.agg(F.max(F.size(parts))).first()[0]
        raw = lines.select(*[parts.getItem(i).alias(f"c{i}") for i in range(width)])
    else:
        # Quoted newlines make a file one split, so they are only allowed for where
        # some line has an odd number of quotes.
        open_quote = (F.length("value") - F.length(F.replace("value", F.lit('"')))) % 2 == 1
        several = not spark.read.text(path).filter(open_quote).isEmpty()
        raw = (spark.read.option("sep", sep).option("header", bool(header)).option("quote", '"')
               .option("escape", '"').option("multiLine", several)
               .option("inferSchema", "false").option("mode", "PERMISSIVE").csv(path))
    return _typed(raw)


def dataset_name(path: str) -> str:
    """``parentdir/filename``."""
    p = re.sub(r"^file:", "", path)
    return f"{os.path.basename(os.path.dirname(p))}/{os.path.basename(p)}"


def write_reduced_csv(df: DataFrame, out: str, target: str, features: list[str],
                      partition_by: str | None = None) -> None:
    """Target first, then the features; header, no index column."""
    cols = ([partition_by] if partition_by else []) + [target] + list(features)
    w = df.select(*(named(c) for c in cols)).write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(out)
