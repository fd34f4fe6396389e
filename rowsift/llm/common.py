"""Helpers shared by the text operators.

Inside tasks texts are handled as Arrow arrays in slices of a bounded number
of bytes, so that a task's memory does not follow the batch or file size (one
single text larger than a slice forms a slice of its own).
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsift.session import ensure_checkpoint_dir

SLICE_BYTES = 2 << 20
HASH_BLOCK = 1 << 19
LONG_WORD = 256
FREE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
ROW_GROUP = 16 << 20    # bytes that a task holds of a table it writes
_FACTOR = 0x9E3779B97F4A7C15
CODEC = pa.Codec("zstd", compression_level=1)
PLANES = 1 << 63        # marks packed numbers that lie plane by plane
_libc: dict = {}
_kept: dict = {}
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_A_TO_Z = np.arange(256, dtype=np.uint8)
_A_TO_Z[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def fold(doc_id: str, k: int = 5) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(quoted(doc_id).cast("string"), F.lit(""))) % k


def small_batches(spark: SparkSession) -> None:
    """Hand tasks 2,000 rows at a time instead of Spark's default of 10,000 (an explicit
    setting stays): the rows of a batch are in memory at once, on both sides."""
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, "2000")


def stored(df: DataFrame, name: str, batch_rows: int = 0, free: bool = False) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    read it back: cuts the lineage, survives lost executors, computes ``df``
    only once and is identical for every later reader. ``batch_rows`` bounds the
    rows that a task hands to Python at once while it is written (their bytes are always
    bounded: a row may hold a whole block of texts); ``free`` drops its
    shuffle files once it is."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    wanted = {BYTES_SETTING: str(BATCH_BYTES)}
    if batch_rows:
        wanted[BATCH_SETTING] = str(batch_rows)
    if free:
        wanted[FREE_SETTING] = "true"
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def keep_rows(docs: DataFrame, text_col: str, decide: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text ``decide`` keeps (a mask for an array of
    texts); all columns stay. One scan, no shuffle: only the text goes to Python and only a
    boolean comes back."""
    small_batches(docs.sparkSession)

    def kept(texts: pa.Array) -> pa.Array:
        rows = pa.RecordBatch.from_arrays([texts], names=["text"])
        return pa.array(np.concatenate([np.asarray(decide(part), bool) for _, part in slices(iter([rows]))] or [np.zeros(0, bool)]))

    return docs.filter(F.arrow_udf(kept, "boolean")(quoted(text_col)))


def texts_of(column: pa.Array) -> pa.Array:
    """The column as plain strings, null texts as empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batches: Iterator[pa.RecordBatch], column: int = 0, max_bytes: int = SLICE_BYTES,
           max_rows: int = 60_000) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, their texts) in slices of at most ``max_bytes`` of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
            stop = min(stop, start + max_rows)
            yield batch.slice(start, stop - start), texts_of(texts.slice(start, stop - start))
            start = stop
        give_back()


def stage_kept(key: str, make: Callable):
    """``make()``, kept in this worker for the tasks of one stage (outside tasks: for good)."""
    context = TaskContext.get()
    stage = None if context is None else context.stageId()
    _kept[key] = stage, _kept[key][1] if key in _kept else make()
    return _kept[key][1]


def give_back() -> None:
    """Return freed memory to the system, and what was kept for other stages: workers live on
    between tasks, and what they and their allocators keep counts against the executor's memory."""
    context = TaskContext.get()
    for key in [k for k, (stage, _) in _kept.items() if context is not None and stage != context.stageId()]:
        del _kept[key]
    pa.default_memory_pool().release_unused()
    if "trim" not in _libc:
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        _libc["trim"] = trim or (lambda _: 0)
    _libc["trim"](0)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs without ASCII white space) and the offsets per text."""
    parts = pc.ascii_split_whitespace(texts)
    flat, starts = parts.flatten(), np.asarray(parts.offsets, dtype=np.int64)
    starts = starts - starts[0]
    full = np.asarray(pc.binary_length(flat)) > 0
    if full.all():
        return flat, starts
    return flat.filter(pa.array(full)), np.concatenate(([0], np.cumsum(full)))[starts]


def coded(flat: pa.Array) -> tuple[list[str], np.ndarray]:
    """Distinct words and each word's index among them."""
    d = flat.dictionary_encode()
    return d.dictionary.to_pylist(), np.asarray(d.indices, dtype=np.int64)


def hash_words(words: list[str], seed: int = 0) -> np.ndarray:
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w.encode("utf-8", "surrogatepass"), seed) for w in words),
                       np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (murmur3 constants), vectorised."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def per_text(starts: np.ndarray) -> np.ndarray:
    """The text index of every word."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def segment_sum(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets (0 for empty texts)."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def word_spans(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes, begin and end of every word in them, and offsets per text.

    ``lower`` turns A-Z into a-z."""
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    buf = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0]:at[-1]]
    at = at - at[0]
    if lower:
        buf = _A_TO_Z[buf]
    word = _IS_WORD[buf]
    if not len(buf):
        none = np.zeros(0, np.int64)
        return buf, none, none, np.zeros(n + 1, np.int64)
    edge = np.zeros(len(buf), bool)
    edge[1:] = word[:-1]
    edge[at[:-1][at[:-1] < len(buf)]] = False
    begin = np.flatnonzero(word & ~edge)
    edge[:-1] = word[1:]
    edge[-1] = False
    edge[at[1:][at[1:] > 0] - 1] = False
    end = np.flatnonzero(word & ~edge) + 1
    return buf, begin, end, np.searchsorted(begin, at)


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:
    if cache.get("n", 0) < n:
        up = np.full(n, _FACTOR, np.uint64)
        down = np.full(n, pow(_FACTOR, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        cache |= {"n": n, "up": np.cumprod(up), "down": np.cumprod(down)}
    return cache["up"][:n], cache["down"][:n]


def span_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every span: a polynomial in its bytes, from running sums over
    blocks of bounded size, mixed with its length. Spans of over ``LONG_WORD`` bytes, for which words of equal
    polynomials are easily written down whatever its factor, get a hash of their bytes instead."""
    out = np.empty(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        first = int(begin[i])
        j = max(i + 1, int(np.searchsorted(end, first + HASH_BLOCK, "right")))
        a, b = begin[i:j] - first, end[i:j] - first
        up, down = _powers(int(b[-1]))
        run = np.zeros(int(b[-1]) + 1, np.uint64)
        np.cumsum((buf[first:first + int(b[-1])].astype(np.uint64) + np.uint64(1)) * up, out=run[1:])
        out[i:j] = mix((run[b] - run[a]) * down[a] ^ (b - a).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        i = j
    for i in np.flatnonzero(end - begin > LONG_WORD):
        out[i] = xxhash.xxh3_64_intdigest(buf[begin[i]:end[i]].tobytes())
    return out


def hash_texts(words: list[str]) -> np.ndarray:
    """``span_hashes`` of whole strings without white space."""
    buf, begin, end, _ = word_spans(pa.array(words, pa.large_string()))
    return span_hashes(buf, begin, end)


def packed(x: np.ndarray, planes: bool = False) -> bytes:
    """``planes``: all first bytes, then all second ones and so on, in which numbers pack better."""
    data = x
    if planes:
        rows = x.view(np.uint8).reshape(-1, x.itemsize)
        data = np.empty(rows.shape[::-1], np.uint8)
        for j, plane in enumerate(data):                   # some times faster than tobytes() of the transposed array
            plane[:] = rows[:, j]
    return (x.nbytes | planes * PLANES).to_bytes(8, "little") + CODEC.compress(data.tobytes(), asbytes=True)


def unpacked(cell: bytes, kind) -> np.ndarray:
    size = int.from_bytes(cell[:8], "little")
    planes, size = size & PLANES, size & ~PLANES
    data = CODEC.decompress(cell[8:], size, asbytes=True) if size else b""
    if not planes:
        return np.frombuffer(data, kind)
    out = np.empty(size // np.dtype(kind).itemsize, kind)
    rows = out.view(np.uint8).reshape(-1, out.itemsize)
    for j, plane in enumerate(np.frombuffer(data, np.uint8).reshape(out.itemsize, -1)):
        rows[:, j] = plane
    return out


def cells(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [unpacked(x, kind) for x in column.to_pylist()]


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *cells(column, kind)])


def column_of(arrays, planes: bool = False) -> pa.Array:
    return pa.array([packed(x, planes) for x in arrays], pa.binary())


def gaps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as the first one and the distances between them: fewer bytes once packed."""
    return np.diff(keys, prepend=np.zeros(1, np.uint64))


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Bounds of the hash range's parts among sorted keys."""
    at = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(at, np.arange(parts + 1))
