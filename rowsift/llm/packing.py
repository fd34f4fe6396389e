"""Best-fit packing by minimum bin slack.

Documents become token ids followed by one separator id; only longer ones are
cut into pieces of ``capacity`` ids. A bin is filled by minimum bin slack: it starts with
the longest piece left, and a bitset subset-sum dynamic programme over the
lengths still available finds the combination that fills the rest best; the
combination is removed.

Pieces of one length are interchangeable, so the plan needs only the histogram
of lengths (at most ``capacity`` numbers, the only thing the driver sees): a combination is
repeated as often as the counts allow, which is what filling bin after
bin gives as well, since the best combination stays the best while it is
available. The plan has a few rows per length at any input size; every piece finds its
place from its rank among the pieces of its length (rank within the task, plus the
counts of the tasks before).

Tokenized pieces are written once to the shared folder (no texts, no ids unless
asked for), so that ranks are the same for every later reader.

Defined cases: null text counts as empty (the separator alone); null ids stay
null; repeated rows are packed one by one; other columns are ignored; an empty table gives
an empty result; a very long text is encoded block by block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import quoted, slices, small_batches, stored, table, word_spans
from .token_counts import lookup, word_table
from .tokenizer import WordTable, encoder

CAPACITY = 2048
TABLE_SIZE = 1 << 18
BLOCK_WORDS = 500_000


def gather(index: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The ids of all entries in ``index`` in a row."""
    first = np.cumsum(sizes) - sizes
    n = sizes[index]
    out = np.cumsum(n)
    total = int(out[-1]) if len(out) else 0
    return ids[np.repeat(first[index] - (out - n), n) + np.arange(total)]


def encode_texts(texts: pa.Array, words: WordTable | None, enc, separator: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """All ids (uint32, the separator after each text) and offsets per text."""
    if words is None:
        lists = [np.asarray([*x, separator], np.uint32) for x in enc.ids(texts.to_pylist())]
        return (np.concatenate(lists) if lists else np.zeros(0, np.uint32),
                np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64))))
    buf, begin, end, starts = word_spans(texts)
    parts, counts = [], []
    for a in range(0, max(len(begin), 1), BLOCK_WORDS):
        block = slice(a, a + BLOCK_WORDS)
        index, _, extra = lookup((buf, begin[block], end[block]), words, enc)
        more = np.frombuffer(b"".join(extra), np.uint32)
        size = np.concatenate((words.sizes, [len(x) // 4 for x in extra])).astype(np.int64)
        parts.append(gather(index, size, np.concatenate((words.ids, more))))
        counts.append(size[index])
    n = np.concatenate((*counts, [0]))
    run = np.concatenate(([0], np.cumsum(n)))[starts]
    ids = np.insert(np.concatenate(parts), run[1:], np.uint32(separator))
    return ids, run + np.arange(len(starts))


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, separator: int, text_col: str, id_col: str,
              with_ids: bool, table_size: int) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    enc = encoder(tokenizer)
    shared = spark.sparkContext.broadcast(word_table(docs, enc, text_col, table_size))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        words = shared.value if enc.by_word else None
        split = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch, texts in slices(batches):
            ids, offsets = encode_texts(texts, words, enc, separator)
            raw = memoryview(ids.astype("<u4").tobytes())
            row, piece, start, length, crc, rank, lists = [], [], [], [], [], [], []
            for r, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                for k, s in enumerate(range(a, b, capacity)):
                    n = min(capacity, b - s)
                    row.append(r)
                    piece.append(k)
                    start.append(s - a)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * s:4 * (s + n)]))
                    rank.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        lists.append(ids[s:s + n])
            columns = [batch.column(1).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                       pa.array([split] * len(row), pa.int64()), pa.array(rank, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32", "split", "rank"]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.uint32())).cast(pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.select(quoted(id_col)).schema[0].dataType.simpleString()
    schema = (f"id {kind}, piece int, start long, length long, ids_crc32 long, split long, rank long"
              + (", ids array<int>" if with_ids else ""))
    return docs.select(quoted(text_col).alias("text"), quoted(id_col).alias("id")).mapInArrow(cut, schema)


def fullest(counts: np.ndarray, available: list[int], room: int) -> dict[int, int]:
    """Best combination of available lengths for ``room``: length -> how often.

    Bitset subset sums: bit s of ``reach`` says that sum s can be made; copies
    of one length are taken in powers of two."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for n in available:
        if n > room or reach >> room & 1:
            continue
        left, take = min(int(counts[n]), room // n), 1
        while left > 0:
            take = min(take, left)
            steps.append((n, take, reach))
            reach |= reach << (n * take) & mask
            left -= take
            take *= 2
    s, out = reach.bit_length() - 1, {}
    for n, take, before in reversed(steps):
        if not before >> s & 1:
            out[n] = out.get(n, 0) + take
            s -= n * take
    return out


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(combination: length -> pieces per bin, number of bins) until nothing is left."""
    counts = np.zeros(capacity + 1, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    plan = []
    while True:
        available = np.flatnonzero(counts)[::-1].tolist()
        if not available:
            return plan
        first = available[0]
        counts[first] -= 1
        combo = fullest(counts, [n for n in available if counts[n] > 0], capacity - first)
        counts[first] += 1
        combo[first] = combo.get(first, 0) + 1
        times = min(int(counts[n]) // k for n, k in combo.items())
        for n, k in combo.items():
            counts[n] -= k * times
        plan.append((combo, times))


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length rows of (first rank, pieces per bin, first bin, offset in the bin)."""
    rows: dict[int, list] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for combo, times in plan:
        offset = 0
        for n in sorted(combo, reverse=True):
            rows.setdefault(n, []).append((used.get(n, 0), combo[n], first_bin, offset))
            used[n] = used.get(n, 0) + combo[n] * times
            offset += n * combo[n]
        first_bin += times
    return {n: np.array(x, np.int64) for n, x in rows.items()}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = 0,
         text_col: str = "text", id_col: str = "doc_id", with_ids: bool = False,
         table_size: int = TABLE_SIZE) -> DataFrame:
    """One row per piece with its sequence and its offset there (and its ids)."""
    pieces = stored(pieces_of(docs, tokenizer, capacity, separator, text_col, id_col, with_ids, table_size),
                    "pieces")
    counts = pieces.groupBy("split", "length").agg((F.max("rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("split", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(places(plan_bins(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = shared.value
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank")) + np.asarray(batch.column("before"))
            bins, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for at in np.split(order, cuts):
                if len(at):
                    n = int(length[at[0]])
                    rows = where[n][np.searchsorted(where[n][:, 0], rank[at], "right") - 1]
                    k = rank[at] - rows[:, 0]
                    bins[at] = rows[:, 2] + k // rows[:, 1]
                    offset[at] = rows[:, 3] + k % rows[:, 1] * n
            names = [c for c in batch.schema.names if c not in ("split", "rank", "before")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(bins), pa.array(offset)],
                names=names + ["sequence_id", "offset"])

    joined = pieces.join(offsets, ["split", "length"])
    kept = [f for f in joined.schema if f.name not in ("split", "rank", "before")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return (joined.mapInArrow(place, schema + ", sequence_id long, offset long")
            .select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                    *(["ids"] if with_ids else [])))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from ``pack(..., with_ids=True)``; at most ``capacity`` ids each."""
    return (packed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op7_packing": op7_packing}
