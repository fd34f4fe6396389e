"""Language-model scores from a probabilistic suffix tree over words.

Tokens: lower-cased (A-Z) words, then one end token per text. The tree's states
are contexts of 0 to ``depth`` words. Its root is the unigram distribution
``(c + 0.5) / (N + 0.5 (V + 1))``. A longer context is a state only if a
divergence test says that its next-symbol distribution differs from its
suffix's: ``count * KL`` must exceed half a log of the count for each of its symbols
(the description length they cost). Next-symbol distributions are smoothed:
``P(w|s) = max(c(s,w) - d, 0) / c(s) + g(s) P(w|suffix of s)``, with ``g(s)`` the mass
left over, so every state sums to one with its suffix. A token is scored in the state
of the longest retained suffix of the words before it (a text begins after an end token).

Counting. Every n-gram that occurs at least twice in the training texts can enter the
tree, at every input size (``share`` > 0 asks for that share of all tokens besides; the default
is none). Nothing of the model is collected or broadcast: it lives in parts of the contexts'
hash range, about ``PART`` n-grams each. Texts are cut into blocks once. Level by level each block sends its distinct
contexts and n-grams (last word, count, the probability one level below) to the parts of the
contexts; a part adds up the counts, tests its contexts, and answers each block with the counts it
asked for and what the contexts leave over. A context is sent only if it occurs often enough to
be a state, an n-gram only if its last words do too, which the level below has answered. A common n-gram is one entry per block, so no part
follows a common word; rows are at most blocks x parts, and never more than n-grams.
The divergence test reads the lower probability as a 32-bit float, scores use 64 bits.

``learn`` builds the same tree in one place, for a corpus or share whose tree fits a worker.

Words and n-grams are identified by 64-bit hashes.

Defined cases: null text counts as empty (one end token); null ids are scored, and
belong to the fold of the empty text; repeated rows count and are scored one by one; other
columns are ignored; an empty table gives an empty result; without training rows every
word is unknown.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (cells, column_of, fold, gaps, joined, mix, packed, parts_of, per_text, quoted, segment_sum, slices,
                     small_batches, span_hashes, stored, table, word_spans)

DEPTH = 3
SHARE = 0.0
DISCOUNT = 0.5
BLOCK = 1_500_000
GROUP = 2_000_000
PART = 2_000_000
TURNS = {3: 2, 4: 2}               # of a level's parts, one after another: these take the most disk when all are asked at once
BLOCK_BYTES = 8 << 20
END = np.uint64(0x656E64206F662074)  # stands for the end token
STEP = np.uint64(0x9E3779B97F4A7C15)


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with an end token before and after each text's words, and offsets."""
    buf, begin, end, starts = word_spans(texts, lower=True)
    bounds = starts + 2 * np.arange(len(starts))
    out = np.full(bounds[-1], END, np.uint64)
    out[np.arange(len(begin)) + 2 * per_text(starts) + 1] = span_hashes(buf, begin, end)
    return out, bounds


def grams(h: np.ndarray, bounds: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, hash of the n-gram that ends at each position, where it lies in one text)."""
    place = np.arange(len(h)) - np.repeat(bounds[:-1], np.diff(bounds))
    g = h
    for n in range(2, longest + 1):
        before = np.concatenate((np.zeros(1, np.uint64), g[:-1]))
        g = mix(before * STEP + h + np.uint64(n))
        yield n, g, place >= n - 1


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return u, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def unigram_counts(texts: DataFrame) -> DataFrame:
    """(h, c): exact counts of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for _, t in slices(batches):
            h, bounds = token_hashes(t)
            first = np.ones(len(h), bool)
            first[bounds[:-1]] = False
            u, c = np.unique(h[first], return_counts=True)
            keys.append(u)
            counts.append(c)
            size += len(u)
            if size > BLOCK:
                u, c = merged(keys, counts)
                keys, counts, size = [u], [c], 0
        if keys:
            u, c = merged(keys, counts)
            for a in range(0, len(u), 100_000):
                yield pa.RecordBatch.from_arrays([signed(u[a:a + 100_000]), pa.array(c[a:a + 100_000])],
                                                 names=["h", "c"])

    return texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def sorted_find(table_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of every key in the sorted table, -1 where absent."""
    if not len(table_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table_keys, keys), len(table_keys) - 1)
    return np.where(table_keys[at] == keys, at, -1)


class Index:
    """Sorted keys with an index by their leading bits: built once, then a few
    memory accesses for each key looked up."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        slots = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.first = np.searchsorted(keys, slots).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of every key, -1 where absent."""
        at = self.first[(h >> self.shift).astype(np.int64)].astype(np.int64)
        left = np.flatnonzero(self.keys[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.keys[at[left]] < h[left]]
        return np.where((self.keys[at] == h) & (at < len(self.keys) - 1), at, -1)


def candidates(texts: DataFrame, frequent, longest: int, share: float) -> DataFrame:
    """n-grams of frequent words with at least ``share`` of some block's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        levels = range(2, longest + 1)

        def name(block: list[dict[int, np.ndarray]], size: int) -> pa.RecordBatch:
            out = []
            for n in levels:
                u, c = np.unique(np.concatenate([x.pop(n) for x in block]), return_counts=True)
                out.append(u[c >= share * size])
            return pa.RecordBatch.from_arrays([signed(np.concatenate(out))], names=["g"])

        # A finished block waits for the next one, so that a short rest joins it: a block
        # of few tokens would name nearly everything it holds.
        waiting, waiting_size = [], 0
        block, size = [], 0
        for _, t in slices(batches):
            h, bounds = token_hashes(t)
            common = sorted_find(known, h) >= 0
            run_ok = common
            found = {}
            for n, g, inside in grams(h, bounds, longest):
                run_ok = common & np.concatenate(([False], run_ok[:-1]))
                found[n] = g[run_ok & inside]
            block.append(found)
            size += len(h) - len(t)
            if size >= BLOCK:
                if waiting:
                    yield name(waiting, waiting_size)
                waiting, waiting_size = block, size
                block, size = [], 0
        if waiting or block:
            yield name(waiting + block, waiting_size + size)

    return texts.mapInArrow(run, "g long").distinct()


def exact_counts(texts: DataFrame, group: DataFrame, longest: int) -> DataFrame:
    """(g, n, context, suffix, word, c) for the n-grams in ``group`` (bounded size)."""
    keys = group.toArrow().column("g").combine_chunks()
    shared = texts.sparkSession.sparkContext.broadcast(np.sort(np.asarray(keys).view(np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        index = Index(wanted)
        c = np.zeros(len(wanted), np.int64)
        about = np.zeros((len(wanted), 3), np.uint64)
        size = np.zeros(len(wanted), np.int32)
        for _, t in slices(batches):
            h, bounds = token_hashes(t)
            last = h
            for n, g, inside in grams(h, bounds, longest):
                places = np.flatnonzero(inside)
                at = index.find(g[places])
                places, at = places[at >= 0], at[at >= 0]
                c += np.bincount(at, minlength=len(wanted))
                about[at, 0], about[at, 1], about[at, 2] = last[places - 1], last[places], h[places]
                size[at] = n
                last = g
        some = np.flatnonzero(c)
        yield pa.RecordBatch.from_arrays(
            [signed(wanted[some]), pa.array(size[some]), *(signed(np.ascontiguousarray(about[some, k])) for k in range(3)),
             pa.array(c[some])], names=["g", "n", "context", "suffix", "word", "c"])

    return (texts.mapInArrow(run, "g long, n int, context long, suffix long, word long, c long")
            .groupBy("g", "n", "context", "suffix", "word").agg(F.sum("c").alias("c")))


class SuffixTree:
    """Retained contexts (key -> leftover mass) and entries (key -> own mass)."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]
        self.total, self.distinct = total, distinct
        self.base = (self.counts + 0.5) / self.denominator
        self.contexts, self.left = np.zeros(0, np.uint64), np.zeros(0)
        self.entries, self.mass = np.zeros(0, np.uint64), np.zeros(0)
        self._indexes: tuple[Index, Index] | None = None

    def indexes(self) -> tuple[Index, Index]:
        """Of contexts and entries, built once in each worker."""
        if self._indexes is None:
            self._indexes = Index(self.contexts), Index(self.entries)
        return self._indexes

    @property
    def denominator(self) -> float:
        return self.total + 0.5 * (self.distinct + 1)

    def grow(self, rows: dict[str, np.ndarray], discount: float) -> None:
        """Add the levels one by one; ``rows``: the exact n-gram counts."""
        known, known_count, known_p = self.words, self.counts, self.base
        for n in sorted(set(rows["n"].tolist())):
            pick = rows["n"] == n
            g, context, suffix, c = (rows[k][pick] for k in ("g", "context", "suffix", "c"))
            parent, lower = sorted_find(known, context), sorted_find(known, suffix)
            ok = (parent >= 0) & (lower >= 0)  # both are at least as frequent, so they are known
            g, context, c, parent, lower = g[ok], context[ok], c[ok], parent[ok], lower[ok]
            total = known_count[parent].astype(float)
            own, q = np.maximum(c - discount, 0) / total, known_p[lower]
            keys, group = np.unique(context, return_inverse=True)
            kept = np.bincount(group, own, len(keys))
            left = np.clip(1 - kept, 0, 1)
            p = own + left[group] * q
            rest_p = np.maximum(1 - np.bincount(group, p, len(keys)), 1e-12)
            rest_q = np.maximum(1 - np.bincount(group, q, len(keys)), 1e-12)
            divergence = np.bincount(group, p * np.log(p / q), len(keys)) + rest_p * np.log(rest_p / rest_q)
            symbols = np.bincount(group, minlength=len(keys))
            seen = np.zeros(len(keys))
            seen[group] = total
            retained = seen * divergence > 0.5 * np.log(seen + 1) * symbols
            mine = retained[group]
            self.contexts = np.concatenate((self.contexts, keys[retained]))
            self.left = np.concatenate((self.left, left[retained]))
            self.entries = np.concatenate((self.entries, g[mine]))
            self.mass = np.concatenate((self.mass, own[mine]))
            order = np.argsort(g)
            known, known_count, known_p = g[order], c[order], np.where(mine, p, q)[order]
        for keys, values in (("contexts", "left"), ("entries", "mass")):
            order = np.argsort(getattr(self, keys))
            setattr(self, values, getattr(self, values)[order])
            setattr(self, keys, getattr(self, keys)[order])


def learn(texts: DataFrame, depth: int = DEPTH, share: float = SHARE, discount: float = DISCOUNT
          ) -> tuple[SuffixTree, DataFrame]:
    """The tree and the table of unigram counts (h, c) from the column ``text``."""
    spark, texts = texts.sparkSession, texts.select("text")
    counts = stored(unigram_counts(texts), "unigrams")
    row = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    floor = max(2, int(np.ceil(share * row.n)))
    common = counts.filter(F.col("c") >= floor).toArrow()  # at most 1 / share rows
    words = np.asarray(common.column("h").combine_chunks()).view(np.uint64)
    tree = SuffixTree(words, np.asarray(common.column("c").combine_chunks()), row.n, row.v)
    if not len(words):
        return tree, counts
    frequent = spark.sparkContext.broadcast(tree.words)
    # Small input splits are read together: a block needs tokens to tell what is frequent.
    splits = max(1, -(-row.n // BLOCK))
    named = stored(candidates(texts.coalesce(splits), frequent, depth + 1, share), "ngram-candidates")
    groups = max(1, -(-named.count() // GROUP))
    parts = []
    for i in range(groups):
        group = named.filter(F.pmod(F.xxhash64("g"), F.lit(groups)) == i) if groups > 1 else named
        parts.append(exact_counts(texts, group, depth + 1).filter(F.col("c") >= floor).toArrow())
    rows = pa.concat_tables(parts)
    if rows.num_rows:
        cols = {k: np.asarray(rows.column(k).combine_chunks()) for k in rows.column_names}
        for k in ("g", "context", "suffix"):
            cols[k] = cols[k].view(np.uint64)
        tree.grow(cols, discount)
    return tree, counts


def token_scores(h: np.ndarray, bounds: np.ndarray, tree: SuffixTree, depth: int
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per position: index among the frequent words or -1, base and tree probability
    (for other words the factor before their base probability)."""
    word = sorted_find(tree.words, h)
    base = np.append(tree.base, 1.0)[word]
    p = base.copy()
    contexts, entries = tree.indexes()
    last = h
    for _, g, inside in grams(h, bounds, depth + 1):
        places = np.flatnonzero(inside)
        at = contexts.find(last[places - 1])
        places, at = places[at >= 0], at[at >= 0]
        e = entries.find(g[places])
        p[places] = np.append(tree.mass, 0.0)[e] + tree.left[at] * p[places]
        last = g
    return word, base, p


BLOCK_FIELDS = "block long, tokens long, lengths binary, train binary, words binary, codes binary"
def text_blocks(rows: DataFrame, kind: str) -> DataFrame:
    """One row per slice of texts: ids, lengths in tokens, training marks, distinct words, their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for part, t in slices(batches, max_bytes=BLOCK_BYTES):
            h, bounds = token_hashes(t)
            words, codes, c = np.unique(h, return_inverse=True, return_counts=True)
            order = np.argsort(-c, kind="stable")          # common words get small codes, which pack well
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order))
            learned = np.asarray(part.column(2).fill_null(False).cast(pa.uint8()))
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(t)], pa.int32()), part.column(1)), pa.array([block]), pa.array([len(h)]),
                 *(pa.array([packed(x, True)], pa.binary()) for x in (
                     np.diff(bounds).astype(np.int64), learned, words[order], rank[codes]))],
                names=["ids", "block", "tokens", "lengths", "train", "words", "codes"])
            block += 1

    return rows.mapInArrow(run, f"ids array<{kind}>, {BLOCK_FIELDS}")


def asked_words(block: int, words: np.ndarray, c: np.ndarray, parts: int) -> pa.Table:
    """One row for each part that a block's distinct words (sorted) fall into."""
    cut = parts_of(words, parts)
    some = np.flatnonzero(np.diff(cut))
    return pa.table({"part": pa.array(some, pa.int64()), "block": pa.array(np.full(len(some), block), pa.int64()),
                     "g": column_of((gaps(words[cut[i]:cut[i + 1]]) for i in some), True),
                     "c": column_of((c[cut[i]:cut[i + 1]] for i in some), True)})


def word_answer(rows: pa.Table, parts: int) -> pa.Table:
    """Training counts and numbers of a part's words (unique over all parts); the part's tokens
    and distinct words on its first row."""
    sent = [np.cumsum(x, dtype=np.uint64) for x in cells(rows.column("g"), np.uint64)]
    words, at = np.unique(np.concatenate(sent), return_inverse=True)
    c = np.zeros(len(words), np.int64)
    np.add.at(c, at, joined(rows.column("c"), np.int64))
    number = np.empty(len(words), np.int64)
    number[np.argsort(-c, kind="stable")] = np.arange(len(words)) * parts + rows.column("part")[0].as_py()
    at = np.split(at, np.cumsum([len(x) for x in sent])[:-1])
    one = np.zeros(rows.num_rows, np.int64)
    one[0] = 1
    return pa.table({"part": rows.column("part"), "block": rows.column("block"), "c": column_of((c[x] for x in at), True),
                     "rest": column_of((number[x] for x in at), True), "kept": pa.array([b""] * len(at), pa.binary()),
                     "n": pa.array(one * c.sum()), "v": pa.array(one * np.count_nonzero(c))})


ASKED = {"context": np.uint64, "total": np.int64, "runs": np.uint32, "word": np.int64, "q": np.float32, "c": np.int64}


def asked_rows(block: int, asked: dict[str, np.ndarray], parts: int, n: int, turn: int = 0, turns: int = 1) -> pa.Table:
    """One row for each part (of this turn's) that a block's contexts (sorted) and their n-grams fall into. Words
    are sent as the distances between those of a context. The lower probabilities of bigrams are those of
    their last words: one for each distinct word, in order."""
    cut = parts_of(asked["context"], parts)
    inner = np.concatenate(([0], np.cumsum(asked["runs"], dtype=np.int64)))
    word, q = asked["word"], asked["q"].astype(ASKED["q"])
    steps = np.diff(word, prepend=0)
    begin = inner[:-1][asked["runs"] > 0]
    steps[begin] = word[begin]
    inner = inner[cut]
    some = np.flatnonzero(np.diff(cut))
    some = some[some % turns == turn]
    out = {"part": pa.array(some, pa.int64()), "block": pa.array(np.full(len(some), block), pa.int64())}

    def lower(a: int, b: int) -> np.ndarray:
        return q[a:b][np.unique(word[a:b], return_index=True)[1]] if n == 2 else q[a:b]

    for k, kind in ASKED.items():
        x = (steps if k == "word" else asked[k]).astype(kind, copy=False)
        at = inner if k in ("word", "q", "c") else cut
        out[k] = column_of((lower(at[i], at[i + 1]) if k == "q" else gaps(x[at[i]:at[i + 1]]) if k == "context" else x[at[i]:at[i + 1]]
                            for i in some), True)
    return pa.table(out)


def asked_words_of(steps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """The words of all contexts from the distances between them."""
    upto, size = np.cumsum(steps), runs[runs > 0]
    begin = np.cumsum(size) - size
    return upto - np.repeat(upto[begin] - steps[begin], size)


def answer(rows: pa.Table, n: int, floor: int, discount: float) -> pa.Table:
    """Counts of the n-grams asked for; for every context the training count outside its
    entries (``rest``) and the number of its entries (``kept``, 0 unless it is a state)."""
    sent = [np.cumsum(x, dtype=np.uint64) for x in cells(rows.column("context"), np.uint64)]
    x = {k: joined(rows.column(k), ASKED[k]) for k in ASKED if k != "context"}
    grams_in = [len(v) for v in cells(rows.column("c"), np.int64)]
    x["word"] = asked_words_of(x["word"], x["runs"].astype(np.int64))
    if n == 2:
        mine = np.split(x["word"], np.cumsum(grams_in)[:-1])
        x["q"] = np.concatenate([q[np.unique(w, return_inverse=True)[1]] for q, w in zip(cells(rows.column("q"), ASKED["q"]), mine)])
    contexts, where = np.unique(np.concatenate(sent), return_inverse=True)
    total = np.zeros(len(contexts), np.int64)
    total[where] = x["total"]
    group = np.repeat(where, x["runs"])
    _, first, at = np.unique(mix(contexts[group] * STEP + x["word"].astype(np.uint64) + np.uint64(1)),
                             return_index=True, return_inverse=True)
    c = np.zeros(len(first), np.int64)
    np.add.at(c, at, x["c"])
    some = c >= floor
    group, size = group[first][some], len(contexts)
    seen = np.maximum(total, 1).astype(float)
    own, q = np.maximum(c[some] - discount, 0) / seen[group], x["q"][first][some].astype(float)
    symbols = np.bincount(group, minlength=size)
    rest = total.copy()
    np.subtract.at(rest, group, c[some])
    p = own + ((rest + discount * symbols) / seen)[group] * q
    rest_p = np.maximum(1 - np.bincount(group, p, size), 1e-12)
    rest_q = np.maximum(1 - np.bincount(group, q, size), 1e-12)
    divergence = np.bincount(group, p * np.log(p / q), size) + rest_p * np.log(rest_p / rest_q)
    retained = (symbols > 0) & (seen * divergence > 0.5 * np.log(seen + 1) * symbols)
    at = np.split(at, np.cumsum(grams_in)[:-1])
    where = np.split(where, np.cumsum([len(v) for v in sent])[:-1])
    rest, kept = np.where(retained, rest, 0), np.where(retained, symbols, 0)
    return pa.table({"part": rows.column("part"), "block": rows.column("block"), "c": column_of((c[i] for i in at), True),
                     "rest": column_of((rest[i] for i in where), True), "kept": column_of((kept[i] for i in where), True)})


def grouped(keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the keys (below ``limit``), and where in it a new one begins."""
    bits = len(keys).bit_length()
    if int(limit).bit_length() + bits < 64:                # one plain sort of keys and places
        both = np.sort(keys << bits | np.arange(len(keys)))
        order, keys = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
    return order, np.diff(keys, prepend=-1) != 0


class BlockTokens:
    """A block's tokens, with counts and probabilities of the levels answered so far."""

    def __init__(self, row: pa.Table):
        self.block = row.column("block")[0].as_py()
        words = joined(row.column("words"), np.uint64)
        order = np.argsort(words)
        self.words, rank = words[order], np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        self.codes = rank[joined(row.column("codes"), np.uint32)]
        lengths = joined(row.column("lengths"), np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(lengths)))
        self.h = self.words[self.codes]
        self.train = np.repeat(joined(row.column("train"), np.uint8), lengths)
        self.token = np.ones(len(self.h), bool)
        self.token[self.bounds[:-1]] = False

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.codes, self.train * self.token, len(self.words)).astype(np.int64)

    def take_words(self, c: np.ndarray, number: np.ndarray, denominator: float) -> None:
        self.count, self.number = c[self.codes], number
        self.p = ((c + 0.5) / denominator)[self.codes]
        self.base = self.p.copy()
        self.known, self.grams = self.count > 0, self.h
        self.place = np.arange(len(self.h)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        self.ids, self.hashes = self.codes, self.words     # of the n-gram that ends at each position, one level below
        rank = np.empty(len(number), np.int64)
        rank[np.argsort(number)] = np.arange(len(number))
        self.ranked = rank[self.codes]

    def find(self, n: int, floor: int) -> None:
        """Places whose context of ``n - 1`` words occurs ``floor`` times, and of them those whose last ``n - 1``
        words do: the n-grams to ask for, and each place's number among them and among the sorted contexts."""
        grams = np.concatenate((np.zeros(1, np.uint64), self.grams[:-1]))
        grams *= STEP
        grams += self.h
        grams += np.uint64(n)
        self.grams = mix(grams)
        often = self.count >= floor
        use = self.place >= n - 1
        use[1:] &= often[:-1]
        self.places = np.flatnonzero(use)
        before = self.places - 1
        self.total = self.count[before]
        below = self.ids[before]
        used = np.zeros(len(self.hashes), bool)
        used[below] = True
        used = np.flatnonzero(used)
        context = self.hashes[used]
        order = np.argsort(context)
        self.context, rank = context[order], np.empty(len(self.hashes), np.int64)
        rank[used[order]] = np.arange(len(used))
        self.owner = rank[below]
        self.asked = np.flatnonzero(often[self.places])
        ends, owner = self.places[self.asked], self.owner[self.asked]
        order, new = grouped(owner * len(self.words) + self.ranked[ends], len(context) * len(self.words))
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.one = self.asked[order[new]]
        self.ids = np.full(len(self.h), -1)
        self.ids[ends], self.hashes = self.at, self.grams[self.places[self.one]]

    def ask(self, n: int, floor: int) -> dict[str, np.ndarray]:
        """The block's contexts of ``n - 1`` words that occur ``floor`` times, sorted, and their
        n-grams whose last ``n - 1`` words do."""
        self.find(n, floor)
        first = self.places[self.one]
        total = np.empty(len(self.context), np.int64)
        total[self.owner] = self.total
        return {"context": self.context, "total": total, "runs": np.bincount(self.owner[self.one], minlength=len(self.context)),
                "word": self.number[self.codes[first]], "q": self.p[first],
                "c": np.bincount(self.at, self.train[self.places[self.asked]], len(first))}

    def take(self, c: np.ndarray, rest: np.ndarray, kept: np.ndarray, floor: int, discount: float) -> None:
        count = np.zeros(len(self.places), np.int64)
        count[self.asked] = c[self.at]
        state = np.flatnonzero((kept > 0)[self.owner])
        places, total, mine = self.places[state], self.total[state], count[state]
        own = np.where(mine >= floor, (mine - discount) / total, 0)
        left = (rest + discount * kept)[self.owner[state]] / total
        self.p[places] = own + left * self.p[places]
        self.count = np.zeros(len(self.h), np.int64)
        self.count[self.places] = count


def lm_scores(docs: DataFrame, learn_from: Column, text_col: str = "text", id_col: str = "doc_id",
              depth: int = DEPTH, share: float = SHARE, discount: float = DISCOUNT) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    small_batches(docs.sparkSession)
    text = F.coalesce(quoted(text_col), F.lit("")).alias("text")
    rows = docs.select(text, quoted(id_col).alias("id"), learn_from.alias("train"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = stored(text_blocks(rows, kind), "lm-blocks")
    tokens = blocks.agg(F.sum("tokens")).first()[0] or 0
    parts = max(1, -(-tokens // PART))
    sent = "part long, block long, " + ", ".join(f"{k} binary" for k in ASKED)
    replies = "part long, block long, c binary, rest binary, kept binary"

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tokens_of = BlockTokens(pa.Table.from_batches([batch.slice(i, 1)]))
                yield from asked_words(tokens_of.block, tokens_of.words, tokens_of.word_counts(), parts).to_batches()

    words = (blocks.drop("ids").mapInArrow(ask_words, "part long, block long, g binary, c binary").groupBy("part")
             .applyInArrow(lambda x: word_answer(x, parts), f"{replies}, n long, v long"))
    words = stored(words, "lm-words", free=True)
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    denominator, floor = size.n + 0.5 * (size.v + 1), max(2, int(np.ceil(share * size.n)))
    answers = words.select(F.lit(1).alias("n"), "part", "block", "c", "rest", "kept")

    def caught_up(block: pa.Table, said: pa.Table, n: int) -> BlockTokens:
        """The block with the answers of the levels below ``n``."""
        out = BlockTokens(block)
        order = np.lexsort((np.asarray(said.column("part")), np.asarray(said.column("n"))))
        said = said.take(pa.array(order))
        level = np.asarray(said.column("n"))
        for k in range(1, n):
            a, b = np.searchsorted(level, (k, k + 1))
            mine = said.slice(a, b - a)
            c, rest = joined(mine.column("c"), np.int64), joined(mine.column("rest"), np.int64)
            if k == 1:
                out.take_words(c, rest, denominator)
            else:
                out.find(k, floor)
                out.take(c, rest, joined(mine.column("kept"), np.int64), floor, discount)
        return out

    def every(f, schema: str, *extra: str) -> DataFrame:
        return (blocks.select(*extra, "block", "lengths", "train", "words", "codes").groupBy("block")
                .cogroup(answers.groupBy("block")).applyInArrow(f, schema))

    def asking(n: int, turn: int, turns: int):
        def ask(block: pa.Table, said: pa.Table) -> pa.Table:
            state = caught_up(block, said, n)
            return asked_rows(state.block, state.ask(n, floor), parts, n, turn, turns)

        return ask

    def answering(n: int):
        return lambda x: answer(x, n, floor, discount)

    for n in range(2, depth + 2):
        told, turns = [], min(TURNS.get(n, 1), parts)
        for turn in range(turns):
            found = every(asking(n, turn, turns), sent).groupBy("part").applyInArrow(answering(n), replies)
            told.append(stored(found, "lm-answers", free=True).select(F.lit(n).alias("n"), "part", "block", "c", "rest", "kept"))
        for x in told:
            answers = answers.union(x)

    def score(block: pa.Table, said: pa.Table) -> pa.Table:
        state = caught_up(block, said, depth + 2)

        def total(x: np.ndarray) -> pa.Array:
            return pa.array(segment_sum(np.where(state.token, x, 0).astype(x.dtype), state.bounds))

        return pa.table({"id": block.column("ids").combine_chunks().flatten(), "n_tokens": np.diff(state.bounds) - 1,
                         "n_known": total(state.known.astype(np.int64)),
                         "base_score": total(np.log10(state.base)), "score": total(np.log10(state.p))})

    out = every(score, f"id {kind}, n_tokens long, n_known long, base_score double, score double", "ids")
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(size.n).cast("long").alias("train_tokens"),
                      "base_score", "score")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scores(table(spark, sf_dir, "documents"), fold("doc_id") != 1)
    return scores.select("doc_id", (fold("doc_id") == 1).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


QUERIES = {"op2_lm_scoring": op2_lm_scoring}
