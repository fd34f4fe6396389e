"""Token counts by a two-tier lookup on the map side.

Tier 1 is a compact table (word -> number of tokens) of the most frequent
pre-tokens, broadcast to every task. It is found from bounded per-task
summaries of all texts (each task keeps its most frequent words only), merged
to ``table_size`` words of at most ``MAX_WORD_BYTES`` bytes, so its size is
bounded by ``table_size * (MAX_WORD_BYTES + 8)`` bytes at every input size.
Tier 2 encodes the remaining words with the tokenizer itself through a cache in
each Python worker. No pre-token is shuffled; the table only saves work, counts
never depend on it.

Defined cases: null text counts as empty (0 tokens, 0 bytes); a null id is
returned as null; repeated rows are counted one by one; other columns,
whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hash_texts, quoted, segment_sum, slices, small_batches, span_hashes, stored, table, word_spans
from .tokenizer import WordTable, encoder

MAX_WORD_BYTES = 64
TABLE_SIZE = 1 << 18
TASK_SUMMARY = 1 << 15


def frequent_words(docs: DataFrame, text_col: str = "text", table_size: int = TABLE_SIZE,
                   task_summary: int = TASK_SUMMARY) -> list[str]:
    """Most frequent words over all texts, from bounded summaries per task."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        names: dict[int, bytes] = {}
        for _, texts in slices(batches):
            buf, begin, end, _ = word_spans(texts)
            u, first, n = np.unique(span_hashes(buf, begin, end), return_index=True, return_counts=True)
            few = np.flatnonzero((n > 1) & (end[first] - begin[first] <= MAX_WORD_BYTES))
            for key, k, i in zip(u[few].tolist(), n[few].tolist(), first[few].tolist()):
                if key in seen:
                    seen[key] += k
                else:
                    seen[key] = k
                    names[key] = buf[begin[i]:end[i]].tobytes()
            if len(seen) > 4 * task_summary:
                seen = dict(sorted(seen.items(), key=lambda x: -x[1])[:2 * task_summary])
                names = {k: names[k] for k in seen}
        top = sorted(seen.items(), key=lambda x: -x[1])[:task_summary]
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[k].decode() for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())],
            names=["word", "n"])

    merged = stored(docs.select(quoted(text_col).alias("text")).mapInArrow(summary, "word string, n long")
                    .groupBy("word").agg(F.sum("n").alias("n"))
                    .withColumn("step", F.floor(F.log2("n") * 16).cast("int")), "frequent-words")
    # A histogram of the counts says from which count on the words fit the table, so
    # nothing is sorted and no task returns more than what is kept.
    sizes = {r.step: r["count"] for r in merged.groupBy("step").count().collect()}
    room, least = table_size, max(sizes, default=0) + 1
    for step in sorted(sizes, reverse=True):
        if sizes[step] > room:
            break
        room, least = room - sizes[step], step
    top = merged.filter(F.col("step") >= least)
    rest = merged.filter(F.col("step") == max((s for s in sizes if s < least), default=-1)).limit(room)
    return top.union(rest).select("word").toArrow().column("word").to_pylist()


def word_table(docs: DataFrame, enc, text_col: str, table_size: int, task_summary: int = TASK_SUMMARY) -> WordTable:
    """The broadcast tier: ids of the most frequent words (empty for other tokenizers)."""
    words = frequent_words(docs, text_col, table_size, task_summary) if enc.by_word else []
    return WordTable(hash_texts(words), enc.words(words))


def lookup(words: tuple, known: WordTable, enc) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For the words (bytes, begins, ends): each one's index in the table, or the table's
    size plus its index among the distinct misses; where they miss; the misses' ids."""
    buf, begin, end = words
    h = span_hashes(buf, begin, end)
    index = known.find(h)
    miss = np.flatnonzero(index < 0)
    if not len(miss):
        return index, miss, []
    u, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
    index[miss] = len(known) + inverse
    at = miss[first]
    return index, miss, enc.hashed_words(
        u, lambda i: buf[begin[at[i]]:end[at[i]]].tobytes().decode())


def count_tokens(docs: DataFrame, tokenizer: str, text_col: str = "text", id_col: str = "doc_id",
                 table_size: int = TABLE_SIZE) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    enc = encoder(tokenizer)
    words = word_table(docs, enc, text_col, table_size)
    words.ids = None  # only the lengths are needed
    shared = spark.sparkContext.broadcast(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        known = shared.value
        for rows, texts in slices(batches):
            if enc.by_word:
                buf, begin, end, starts = word_spans(texts)
                index, _, ids = lookup((buf, begin, end), known, enc)
                sizes = np.concatenate((known.sizes, [len(x) // 4 for x in ids])).astype(np.int64)
                n_tokens = segment_sum(sizes[index], starts)
            else:
                n_tokens = np.array([len(x) for x in enc.ids(texts.to_pylist())], np.int64)
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), rows.column(2), pa.array(n_tokens)],
                names=["id", "n_bytes", "n_tokens"])

    kind = docs.select(quoted(id_col)).schema[0].dataType.simpleString()
    out = docs.select(quoted(text_col).alias("text"), quoted(id_col).alias("id"),
                      F.coalesce(F.octet_length(quoted(text_col)), F.lit(0)).cast("long").alias("n_bytes"))
    return out.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


QUERIES = {"op10_token_counts": op10_token_counts}
