"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles.

Shingles are five lower-cased words in a row (a shorter text is one shingle). A
shingle weighs ``(1 + ln tf) * (1 + idf / 2)``, idf scaled to 0..1, taken to the nearest of a
geometric grid of weights. Document frequencies are exact, from all documents: blocks of
texts send their distinct shingles with the number of texts that hold them to parts of the
hash range (``PART`` shingles each, a common one is one entry per block), which answer each
block with the idf of what it sent. Every text keeps its shingles' weights, one byte each.

Signatures: 64 samples by improved consistent weighted sampling; the Gamma and
uniform draws come from a fixed table of ``2**16`` entries addressed by the
shingle's hash, so a sample costs one multiplication and one lookup. 64 more samples give
every shingle the same weight, so they estimate the plain similarity. 16 bands
of 4 samples each: two texts with weighted or with plain similarity 0.8 meet in a band
with probability 0.9998.

Pairs that meet in a band and whose signatures do not rule both similarities out (five
standard errors below them) are verified on their whole texts: a pair is a link if the
weighted Jaccard similarity is 0.8 or more, or the plain one of the same shingles is (idf lowers the
weights of what a large group of copies shares, which must not split the group).

Links become classes without comparing all pairs of a group. Equal texts are
one node. In each bucket every member is compared with a few leaders (the smallest
seeded hashes); connected components follow; then, where a bucket still holds
several components, members meet new leaders of other components, and at last
every member outside the bucket's largest component meets all members of other
components: as pairs in buckets of up to 32 members, block against block inside tasks
in larger ones, where only links come out. So every pair of a bucket is either compared, or already in one
class: no cap, no lost link. Components are found by label propagation with pointer jumping
over written tables.

Defined cases: null counts as the empty text; texts without words form classes of
equal texts only; null ids are kept (a class's id is its smallest non-null id, null if
it has none); repeated rows are one class; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (cells, column_of, gaps, give_back, joined, mix, parts_of, per_text, quoted, slices, small_batches,
                     span_hashes, stored, table, texts_of, word_spans)

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
DF_BITS = 20
PART = 2_000_000
BLOCK_BYTES = 4 << 20
BLOCK_BITS = 12
GRID = 0.05
LEVELS = 80
LEADERS = 3
SMALL = 32
BLOCK_ROWS = 512
BLOCK_WEIGHT = 400_000
BROADCAST_BYTES = 32 << 20
ODD = (mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
       | np.uint64(1))
_tables: dict = {}


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every text: (48-bit hashes, how often, offsets)."""
    buf, begin, end, starts = word_spans(pc.utf8_lower(texts))
    n = np.diff(starts)
    out = np.zeros(0, np.uint64)
    doc = np.zeros(0, np.int64)
    if len(begin):
        h = span_hashes(buf, begin, end)
        text = per_text(starts)
        if len(h) >= WORDS:
            g = h[:len(h) - WORDS + 1].copy()
            for k in range(1, WORDS):
                g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - WORDS + 1 + k])
            inside = text[:len(g)] == text[WORDS - 1:]
            out, doc = g[inside], text[:len(g)][inside]
        short = np.flatnonzero((n > 0) & (n < WORDS))
        if len(short):
            whole = []
            for t in short:
                g = h[starts[t]:starts[t] + 1]
                for k in range(starts[t] + 1, starts[t + 1]):
                    g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[k:k + 1])
                whole.append(g[0] ^ np.uint64(n[t]))
            out, doc = np.concatenate((out, np.array(whole, np.uint64))), np.concatenate((doc, short))
    owned = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (out >> np.uint64(16)))
    new = np.ones(len(owned), bool)
    new[1:] = owned[1:] != owned[:-1]
    at = np.flatnonzero(new)
    often = np.diff(np.append(at, len(owned)))
    unique = owned[at]
    owner = (unique >> np.uint64(48)).astype(np.int64)
    offsets = np.searchsorted(owner, np.arange(len(starts)))
    return unique & np.uint64((1 << 48) - 1), often, offsets


def cell(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(48 - DF_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Cells of hashed document frequencies over all rows, and the number of rows: an
    estimate of bounded size (near_duplicates uses exact ones).

    Every task sums its own cells; arrays of 4096 cells are added up in two steps,
    so that no group holds more than a few hundred of them per step."""
    size = 1 << BLOCK_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, rows = np.zeros(1 << DF_BITS, np.int64), 0
        for batch, texts in slices(batches):
            s, _, _ = shingles(texts)
            cells += np.bincount(cell(s), minlength=1 << DF_BITS)
            rows += batch.num_rows
        blocks = cells.reshape(-1, size)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(blocks))), pa.array(np.full(len(blocks), task)),
             pa.array(list(blocks), pa.list_(pa.int64())),
             pa.array(np.where(np.arange(len(blocks)) == 0, rows, 0))], names=["block", "task", "cells", "rows"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for x in group.column("cells").chunks:
            total += np.asarray(x.flatten()).reshape(-1, size).sum(axis=0)
        return pa.table({"block": group.column("block").slice(0, 1), "task": group.column("task").slice(0, 1),
                         "cells": pa.array([total], pa.list_(pa.int64())),
                         "rows": pa.array([pc.sum(group.column("rows")).as_py()], pa.int64())})

    schema = "block long, task long, cells array<long>, rows long"
    parts = docs.select("text").mapInArrow(count, schema)
    parts = parts.groupBy("block", F.expr("task div 256").alias("part")).applyInArrow(add, schema)
    out = parts.groupBy("block").applyInArrow(add, schema).toArrow()
    cells, rows = np.zeros((1 << DF_BITS) // size * size, np.int64).reshape(-1, size), 0
    for b, x, n in zip(out.column("block").to_pylist(), out.column("cells").to_pylist(),
                       out.column("rows").to_pylist()):
        cells[b] = x
        rows += n
    return cells.reshape(-1), rows


def idf_levels(cells: np.ndarray, rows: int) -> np.ndarray:
    """ln(1 + idf / 2) of every cell in steps of ``GRID``."""
    idf = np.log1p(rows / np.maximum(cells, 1)) / np.log1p(max(rows, 1))
    return np.round(np.log1p(np.minimum(idf, 1) / 2) / GRID).astype(np.uint8)


def weight_levels(often: np.ndarray, idf: np.ndarray) -> np.ndarray:
    tf = np.where(often > 1, np.round(np.log1p(np.log(often)) / GRID), 0).astype(np.int64)
    return np.minimum(tf + idf, LEVELS - 1)


def levels(s: np.ndarray, often: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weight levels by a table of hashed document frequencies."""
    return weight_levels(often, idf[cell(s)])


def draw_table() -> np.ndarray:
    """For every weight level and hash slot the sample's order (high 32 bits) and
    its step number, spread over the low 32 bits."""
    if "draws" not in _tables:
        rng = np.random.default_rng(20)
        r, c = rng.gamma(2, 1, 1 << 16), rng.gamma(2, 1, 1 << 16)
        beta = rng.random(1 << 16)
        table = np.empty((LEVELS, 1 << 16), np.uint64)
        for level in range(LEVELS):          # one level at a time: the table is all that is held
            step = np.floor(level * GRID / r + beta)
            order = (np.log(c) - r * (step - beta) - r).astype(np.float32)
            bits = order.view(np.uint32)
            bits = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
            spread = step.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
            table[level] = (bits << np.uint64(32)) | spread
        _tables["draws"] = table.reshape(-1)
    return _tables["draws"]


def signatures(s: np.ndarray, level: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Samples of every text with shingles: rows of ``SAMPLES`` 32-bit numbers (plain ones if
    all levels are equal)."""
    draws, start = draw_table(), offsets[:-1][np.diff(offsets) > 0]
    spread = mix(s + np.uint64(1))
    base = level << 16
    out = np.empty((len(start), SAMPLES), np.uint32)
    for k in range(SAMPLES if len(start) else 0):
        m = spread * ODD[k]
        key = draws[base + (m >> np.uint64(48)).astype(np.int64)] ^ ((m >> np.uint64(16)) & np.uint64(0xFFFFFFFF))
        out[:, k] = (np.minimum.reduceat(key, start) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return out


def shingle_blocks(docs: DataFrame) -> DataFrame:
    """One row per slice of texts: their ids, row numbers, keys and shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for rows, texts in slices(batches, max_bytes=BLOCK_BYTES):
            s, often, offsets = shingles(texts)
            whole = pa.array([0, len(texts)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([len(texts)]), pa.array([len(s)]),
                 *(pa.ListArray.from_arrays(whole, c) for c in rows.columns[1:]),
                 column_of([np.diff(offsets)]), column_of([(s >> np.uint64(32)).astype(np.uint16)]),
                 column_of([s.astype(np.uint32)]), column_of([often.astype(np.uint32)])],
                names=["block", "texts", "size", "id", "row", "key", "lengths", "high", "low", "often"])
            block += 1

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"block long, texts long, size long, id array<{kind}>, row array<long>, "
                                "key array<binary>, lengths binary, high binary, low binary, often binary")


def block_shingles(block: pa.Table) -> np.ndarray:
    return (joined(block.column("high"), np.uint16).astype(np.uint64) << np.uint64(32)) | joined(
        block.column("low"), np.uint32)


def weighed_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The blocks, and for each part of the hash range and block the idf levels (``idf``) of the
    block's distinct shingles there, from exact document frequencies."""
    size = blocks.agg(F.coalesce(F.sum("texts"), F.lit(0)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("s")).first()
    parts, rows = max(1, -(-size.s // PART)), size.n

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = pa.Table.from_batches([batch.slice(i, 1)])
                s, c = np.unique(block_shingles(one), return_counts=True)
                cut = parts_of(s << np.uint64(16), parts)
                some = np.flatnonzero(np.diff(cut))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some, pa.int64()), pa.array(np.full(len(some), one.column("block")[0].as_py()), pa.int64()),
                     column_of(gaps(s[cut[k]:cut[k + 1]]) for k in some), column_of(c[cut[k]:cut[k + 1]] for k in some)],
                    names=["part", "block", "s", "c"])

    def answer(group: pa.Table) -> pa.Table:
        sent = [np.cumsum(x, dtype=np.uint64) for x in cells(group.column("s"), np.uint64)]
        _, at = np.unique(np.concatenate(sent), return_inverse=True)
        idf = idf_levels(np.bincount(at, joined(group.column("c"), np.int64)), rows)[at]
        return pa.table({"part": group.column("part"), "block": group.column("block"),
                         "idf": column_of(np.split(idf, np.cumsum([len(x) for x in sent])[:-1]))})

    asked = blocks.select("block", "high", "low").mapInArrow(ask, "part long, block long, s binary, c binary")
    return blocks, stored(asked.groupBy("part").applyInArrow(answer, "part long, block long, idf binary"), "idf", free=True)


def signed_rows(docs: DataFrame) -> DataFrame:
    """(id, row, key, weight, sig, levels): weighted, then plain samples of every row, none
    without words, and the weight levels of its shingles, in the order of ``shingles``."""

    def sign(block: pa.Table, said: pa.Table) -> pa.Table:
        s, often = block_shingles(block), joined(block.column("often"), np.uint32).astype(np.int64)
        lengths = joined(block.column("lengths"), np.int64)
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        said = said.take(pa.array(np.argsort(np.asarray(said.column("part")))))
        _, at = np.unique(s, return_inverse=True)
        level = weight_levels(often, joined(said.column("idf"), np.uint8)[at])
        some = lengths > 0
        sig = np.concatenate([signatures(s, x, offsets) for x in (level, np.zeros_like(level))], axis=1)
        sig = sig.view(np.int32).reshape(-1)
        weight = np.zeros(len(lengths))
        if some.any():
            weight[some] = np.add.reduceat(np.exp(level * GRID), offsets[:-1][some])
        places = np.concatenate(([0], np.cumsum(np.where(some, 2 * SAMPLES, 0))))
        own = level.astype(np.uint8).tobytes()
        give_back()
        return pa.table({**{k: block.column(k).combine_chunks().flatten() for k in ("id", "row", "key")},
                         "weight": weight, "sig": pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(sig)),
                         "levels": pa.array([own[a:b] for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())})

    kind = docs.schema["id"].dataType.simpleString()
    blocks, idf = weighed_blocks(stored(shingle_blocks(docs), "shingle-blocks"))
    return (blocks.groupBy("block").cogroup(idf.groupBy("block")).applyInArrow(
        sign, f"id {kind}, row long, key binary, weight double, sig array<int>, levels binary"))


def stored_levels(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).astype(np.int64)


def similarities(a: pa.Array, b: pa.Array, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted and plain Jaccard similarity of the texts in equal places."""
    sides = [shingles(x) for x in (a, b)]
    return jaccards(sides, [levels(s, often, idf) for s, often, _ in sides])


def jaccards(texts: list[tuple], level: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The same from both sides' shingles and their weight levels."""
    sides, n = [], len(texts[0][2]) - 1
    for (s, _, offsets), x in zip(texts, level):
        w = np.exp(x * GRID)
        pair = np.repeat(np.arange(n), np.diff(offsets)).astype(np.uint64)
        sides.append(((pair << np.uint64(48)) | s, w, pair.astype(np.int64)))
    (ka, wa, pa_), (kb, wb, pb) = sides
    _, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    both = np.bincount(pa_[ia], minlength=n)
    plain = both / np.maximum(np.bincount(pa_, minlength=n) + np.bincount(pb, minlength=n) - both, 1)
    low = np.bincount(pa_[ia], np.minimum(wa[ia], wb[ib]), n)
    high = (np.bincount(pa_, wa, n) + np.bincount(pb, wb, n)) - low
    return low / np.maximum(high, 1e-12), plain


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of every connected component."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node"))
                    .agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near")))
        step = labels.join(near, labels.node == near.a).select(
            "node", "label", F.least("label", "near").alias("new"))
        step = stored(step, "labels")
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("root"))
        after = stored(step.join(jump, "new").select("node", F.col("label").alias("old"),
                                                     F.least("new", "root").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("old <> label").isEmpty():
            return labels


def agreement_needed(similarity: float) -> float:
    """Samples that must agree: they estimate the similarity; five standard errors are left."""
    return similarity * SAMPLES - 5 * (similarity * (1 - similarity) * SAMPLES) ** 0.5


def whole_texts(nodes: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, text, levels) of the representatives in ``nodes`` (column ``rep``)."""
    wanted = stored(nodes.distinct().join(reps.select("rep", "key"), "rep"), "wanted")
    few = wanted.count() * 40 <= BROADCAST_BYTES
    return stored(docs.select("key", "text").join(F.broadcast(wanted) if few else wanted, "key")
                  .groupBy("rep").agg(F.first("text").alias("text")).join(reps.select("rep", "levels"), "rep"), "pair-texts")


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are links, checked on whole texts."""
    sig = reps.select("rep", "sig")
    same = F.zip_with("sig_a", "sig_b", lambda x, y: (x == y).cast("int"))
    agree = F.greatest(*(F.aggregate(F.slice(same, 1 + k * SAMPLES, SAMPLES), F.lit(0), lambda x, y: x + y)
                         for k in range(2)))
    likely = stored(
        pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
        .filter(agree >= agreement_needed(similarity)).select("a", "b"), "likely-pairs")
    texts = whole_texts(likely.select(F.col("a").alias("rep")).union(likely.select("b")), reps, docs)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, left in slices(batches, 2, max_rows=2000):
            right = rows.column(3).cast(pa.large_string())
            weighted, plain = jaccards([shingles(left), shingles(right)], [stored_levels(rows.column(k)) for k in (4, 5)])
            ok = pa.array(np.maximum(weighted, plain) >= similarity - 1e-9)
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(ok), rows.column(1).filter(ok)],
                                             names=["a", "b"])

    full = (likely.join(texts.toDF("a", "text_a", "levels_a"), "a")
            .join(texts.toDF("b", "text_b", "levels_b"), "b").select("a", "b", "text_a", "text_b", "levels_a", "levels_b"))
    return stored(full.mapInArrow(check, "a long, b long"), "links", batch_rows=1000)


def block_links(rows: DataFrame, reps: DataFrame, docs: DataFrame, similarity: float) -> DataFrame:
    """Links of members outside their bucket's main component with members of other
    components, found block against block inside tasks: only links come out.

    A bucket of n members is cut into blocks of bounded size (rows and text), its outside
    members too; every pair of blocks is one group, so no group grows with a bucket."""
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("w") / BLOCK_WEIGHT)).cast("int")
    out = rows.filter("outside").groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("weight") / BLOCK_WEIGHT)).cast("int").alias("nq"))
    texts = whole_texts(rows.select("rep"), reps, docs)
    cut = (rows.join(out, "bucket").withColumn("nm", blocks)
           .select("bucket", "rep", "label", "outside", "nq", "nm",
                   F.pmod(F.xxhash64("rep", F.lit(71)), F.col("nm")).alias("bm"),
                   F.pmod(F.xxhash64("rep", F.lit(72)), F.col("nq")).alias("bq")))

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    members = cut.select("bucket", "rep", "label", F.lit(False).alias("asks"), "bm", every("nq").alias("bq"))
    asking = cut.filter("outside").select("bucket", "rep", "label", F.lit(True).alias("asks"),
                                          every("nm").alias("bm"), "bq")
    cells = (members.unionByName(asking.select(*members.columns)).join(texts, "rep")
             .join(reps.select("rep", "sig"), "rep"))
    needed = agreement_needed(similarity)

    def link(cell: pa.Table) -> pa.Table:
        ask = np.asarray(cell.column("asks"))
        rep, label = np.asarray(cell.column("rep")), np.asarray(cell.column("label"))
        sig = np.asarray(cell.column("sig").combine_chunks().flatten()).reshape(-1, 2, SAMPLES)
        s, _, offsets = shingles(texts_of(cell.column("text")))
        w = np.exp(stored_levels(cell.column("levels")) * GRID)
        keys, column = np.unique(s, return_inverse=True)
        where = [slice(a, b) for a, b in zip(offsets[:-1], offsets[1:])]
        total = np.array([w[x].sum() for x in where])
        others = np.flatnonzero(~ask)
        found = []
        mine = np.zeros(len(keys))
        for q in np.flatnonzero(ask):
            near = others[((sig[others] == sig[q]).sum(axis=2).max(axis=1) >= needed) & (label[others] != label[q])]
            if not len(near):
                continue
            mine[column[where[q]]] = w[where[q]]
            for m in near:
                theirs = w[where[m]]
                both = mine[column[where[m]]]
                low = np.minimum(both, theirs).sum()
                shared = np.count_nonzero(both)
                size = offsets[q + 1] - offsets[q] + offsets[m + 1] - offsets[m] - shared
                if max(low / (total[q] + total[m] - low), shared / size) >= similarity - 1e-9:
                    found.append((min(rep[q], rep[m]), max(rep[q], rep[m])))
            mine[column[where[q]]] = 0
        give_back()
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    links = cells.groupBy("bucket", "bm", "bq").applyInArrow(link, "a long, b long").distinct()
    return stored(links, "links")


def ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    similarity: float = SIMILARITY, row_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, row, class_id, class_size, keep).

    ``row`` is a unique number, taken from ``row_col`` if named; ``keep`` marks one row
    of each class."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(quoted(text_col), F.lit("")).alias("text")
    row = quoted(row_col) if row_col else F.monotonically_increasing_id()
    plain = docs.select(text, quoted(id_col).alias("id"), row.alias("row"))
    plain = plain.withColumn("key", F.unhex(F.md5("text")))
    base = stored(signed_rows(plain.select("text", "id", "row", "key")), "signatures", free=True)
    reps = stored(base.groupBy("key").agg(F.min(F.struct("row", "weight", "sig", "levels")).alias("r"))
                  .select("key", F.col("r.row").alias("rep"), "r.weight", "r.sig", "r.levels"), "representatives")

    bands = F.array(*(F.xxhash64(F.lit(b), *(F.col("sig")[b * ROWS + r] for r in range(ROWS)))
                      for b in range(2 * BANDS)))
    buckets = (reps.filter(F.size("sig") > 0).select("rep", "weight", F.explode(bands).alias("bucket")))

    def leaders(rows: DataFrame, seed: int, n: int, *extra: str) -> list:
        what = F.struct("rep", *extra)
        return [F.min_by(what, F.xxhash64("rep", F.lit(seed + i))).alias(f"l{i}") for i in range(n)]

    shared = buckets.groupBy("bucket").agg(
        *leaders(buckets, 0, LEADERS), F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low <> high")
    members = stored(buckets.join(shared.drop("low", "high"), "bucket"), "buckets")

    def with_leaders(rows: DataFrame, n: int, other) -> DataFrame:
        tall = rows.withColumn("l", F.explode(F.array_distinct(F.array(*(f"l{i}" for i in range(n))))))
        return (tall.filter((F.col("rep") != F.col("l.rep")) & other)
                .select(*ordered("rep", "l.rep")).distinct())

    links = verified(with_leaders(members, LEADERS, F.lit(True)), reps, plain, similarity)
    members = members.select("bucket", "rep", "weight")
    labels = components(links)

    def labelled() -> DataFrame:
        """Members of the buckets that still hold several components."""
        named = (members.join(labels, members.rep == labels.node, "left")
                 .select("bucket", "rep", "weight", F.coalesce("label", "rep").alias("label")))
        several = (named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y"))
                   .filter("x <> y").select("bucket"))
        return stored(named.join(several, "bucket"), "open-buckets")

    def grow(pairs: DataFrame) -> None:
        """Verify the pairs and join the classes that their links connect."""
        nonlocal labels, links
        new = verified(pairs, reps, plain, similarity)
        if not new.isEmpty():
            links = links.union(new)
            labels = components(links)

    # New leaders of other components.
    rows_open = labelled()
    chosen = rows_open.groupBy("bucket").agg(*leaders(rows_open, 100, LEADERS, "label"))
    grow(with_leaders(rows_open.join(chosen, "bucket"), LEADERS, F.col("label") != F.col("l.label")))
    # Everything that is left: in small buckets as pairs, in others block against block.
    rows_open = labelled()
    sizes = rows_open.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"), F.sum("w").alias("w")).select(
        "bucket", F.col("most.label").alias("main"), "n", "w")
    rows_open = stored(rows_open.join(largest, "bucket").withColumn("outside", F.col("label") != F.col("main")),
                       "open-buckets")
    little = rows_open.filter(F.col("n") <= SMALL)
    mine = little.filter("outside").select("bucket", F.col("rep").alias("x"), F.col("label").alias("lx"))
    pairs = (mine.join(little, "bucket")
             .filter((F.col("label") != F.col("lx")) & (~F.col("outside") | (F.col("x") < F.col("rep"))))
             .select(*ordered("rep", "x")).distinct())
    new = verified(pairs, reps, plain, similarity).union(
        block_links(rows_open.filter(F.col("n") > SMALL), reps, plain, similarity))
    if not new.isEmpty():
        labels = components(links.union(new))

    own = (base.select("id", "row", "key").join(reps.select("key", "rep"), "key")
           .join(labels, F.col("rep") == F.col("node"), "left")
           .select("id", "row", F.coalesce("label", "rep").alias("label")))
    classes = own.groupBy("label").agg(
        F.min("id").alias("class_id"), F.count("*").alias("class_size"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    return (own.join(classes, "label")
            .select(F.col("id").alias(id_col), "row", "class_id", "class_size",
                    (F.col("row") == F.col("first.row")).alias("keep")))


def deduplicate(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class; all columns stay. The numbered rows are
    written first, so that the numbers are the same wherever they are read."""
    name = "row_number"
    while name in docs.columns:
        name += "_"
    numbered = stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    out = near_duplicates(numbered, text_col, id_col, similarity, row_col=name)
    dropped = stored(out.filter(~F.col("keep")).select(F.col("row").alias(name)), "duplicates")
    if dropped.count() * 16 <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    return numbered.join(dropped, name, "left_anti").select(*(quoted(c) for c in docs.columns))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "class_size", "keep")


QUERIES = {"op9_near_dedup": op9_near_dedup}
