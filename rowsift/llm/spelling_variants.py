"""Spelling variants: words one edit apart, found through Bloom-guided neighbourhoods.

1. Words are the runs of letters of all texts (``A-Za-z`` and U+00C0-U+00FF, A-Z lower-cased),
   counted inside each task and added up by Spark. A seeded checksum of the row's id and the
   run thins out one run in ``thin``: it loses one letter (planted misspellings).
2. The vocabulary (words of ``min_length`` letters and ``min_count`` occurrences or more) is
   put into blocked Bloom filters, one shard per word length, which are broadcast.
3. Every word generates its edits, probes the shards, and only positives are shuffled to an
   exact join with the vocabulary, which removes the false ones. An inserted letter
   is a deleted one of the longer word, and a replaced letter is generated from the smaller word only,
   so that every pair of near words is generated once.
4. A word's form is its most frequent near word if that is ``ratio`` times as frequent; its root is
   found by doubling the steps along forms (counts grow by ``ratio`` at each step, so there
   are no cycles and few rounds).

Bounds: filters have ``BITS_PER_WORD`` bits a word. Shards are dealt to passes that hold at
most ``filter_bytes`` each (a larger shard is split by hash), one broadcast after the other, so
the driver never holds more than one pass, whatever the vocabulary. Edits are
generated in blocks of ``BLOCK`` candidates, so long words need no more memory than short ones.
A word has no more near words than edits, which bounds the groups of the last aggregate.

Defined cases: null, empty and letterless texts have no words; a null id counts as the empty
text; rows that repeat count each; ties go to the word that is smaller in code-point order; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _A_TO_Z, mix, quoted, slices, small_batches, stored, table

MIN_LENGTH = 6
MIN_COUNT = 5
THIN = 199
RATIO = 5
BITS_PER_WORD = 20
PROBES = 6
LANES = 8              # 64-bit lanes of a block
FILTER_BYTES = 16 << 20
BLOCK = 1 << 20
TABLE_ROWS = 400_000   # distinct words that a task adds up before it sends them
SHORT = 64             # bytes of a run whose checksum is taken for all rows at once
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def checksum_table() -> np.ndarray:
    """The byte table of the reflected checksum polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = checksum_table()


# ---------------------------------------------------------------- words

def letter_runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All runs of letters, A-Z lower-cased, and the text of each."""
    n = len(texts)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    buf = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0]:at[-1]]
    at = at - at[0]
    if not len(buf):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    buf = _A_TO_Z[buf]
    letter = _LETTER[buf]
    letter[1:] |= buf[:-1] == 0xC3        # the second byte of U+00C0-U+00FF
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    starts = at[:-1][at[:-1] < len(buf)]
    first[starts] = letter[starts]
    begin = np.flatnonzero(first)
    ends = np.append(np.cumsum(letter)[begin] - 1, int(letter.sum()))
    text = np.searchsorted(at, begin, "right") - 1
    runs = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends.astype(np.int64)),
                                            pa.py_buffer(np.ascontiguousarray(buf[letter])))
    return runs, text


def thinned(runs: pa.Array, text: np.ndarray, prefixes: list[bytes], min_length: int, thin: int
            ) -> pa.Table:
    """(word, n) of the runs, thinned by the checksum of the row's prefix and the run.

    A checksum of two strings is that of the first, carried on over as many zero bytes as
    the second is long, xor that of the second."""
    long = np.asarray(pc.utf8_length(runs)) >= min_length
    runs, text = runs.filter(pa.array(long)), text[long]
    d = runs.dictionary_encode()
    words, code = d.dictionary, np.asarray(d.indices, dtype=np.int64)
    plain = [w.encode() for w in words.to_pylist()]
    size = np.fromiter(map(len, plain), np.int64, len(plain))
    own = np.fromiter(map(zlib.crc32, plain), np.uint32, len(plain))
    before = np.fromiter(map(zlib.crc32, prefixes), np.uint32, len(prefixes))
    carried = np.empty((SHORT + 1, len(before)), np.uint32)
    carried[0] = before
    for i in range(SHORT):
        carried[i + 1] = _CRC[carried[i] & 0xFF] ^ (carried[i] >> 8)
    sums = carried[np.minimum(size[code], SHORT), text] ^ own[code]
    for i in np.flatnonzero(size[code] > SHORT):
        sums[i] = zlib.crc32(plain[code[i]], int(before[text[i]]))
    hit = sums % thin == 0
    n = np.bincount(code[~hit], minlength=len(plain))
    cut = []
    for i in np.flatnonzero(hit):
        word = plain[code[i]].decode()
        k = int(sums[i]) % len(word)
        if len(word) > min_length:
            cut.append(word[:k] + word[k + 1:])
    seen = np.flatnonzero(n)
    return pa.table({"word": pa.concat_arrays([words.take(pa.array(seen)), pa.array(cut, pa.large_string())]),
                     "n": np.concatenate([n[seen], np.ones(len(cut), np.int64)])})


def added(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, thin: int = THIN) -> DataFrame:
    """(word, n) of all texts; one scan, words added up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part, texts in slices(batches):
            prefixes = [f"{i}:".encode() for i in part.column(1).to_pylist()]
            held.append(thinned(*letter_runs(texts), prefixes, min_length, thin))
            rows += held[-1].num_rows
            if rows > TABLE_ROWS:
                held = [added(held)]
                rows = held[0].num_rows
                if rows > TABLE_ROWS // 2:
                    yield from sent(held.pop())
                    rows = 0
        if held:
            yield from sent(added(held))

    def sent(t: pa.Table) -> list[pa.RecordBatch]:
        t = t.set_column(0, "word", t.column("word").cast(pa.string()))
        return t.combine_chunks().to_batches(max_chunksize=50_000)

    small_batches(docs.sparkSession)
    rows = docs.select(quoted(text_col).alias("_text"), F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("_id"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


# ---------------------------------------------------------------- letters, hashes and filters

def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte per letter (its code point) of all words, and the offsets per word."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    buf = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0]:at[-1]]
    lead = buf == 0xC3
    after = np.zeros(len(buf), bool)
    after[1:] = lead[:-1]
    shorter = np.concatenate(([0], np.cumsum(lead)))
    return (buf + np.where(after, 0x40, 0).astype(np.uint8))[~lead], (at - at[0]) - shorter[at - at[0]]


def spelled(rows: np.ndarray) -> pa.Array:
    """Strings of the rows of letters (a matrix)."""
    flat = rows.ravel()
    two = flat >= 0x80
    last = np.cumsum(1 + two.astype(np.int64)) - 1
    out = np.repeat(flat, 1 + two)
    out[last[two]] -= 0x40
    out[last[two] - 1] = 0xC3
    ends = np.append(last + 1, 0)[np.arange(1, len(rows) + 1) * rows.shape[1] - 1]
    return pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(np.append(0, ends).astype(np.int64)),
                                            pa.py_buffer(out)).cast(pa.string())


def by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their letters as a matrix) for every length among the words."""
    flat, at = letters(words)
    size = np.diff(at)
    for length in np.unique(size):
        rows = np.flatnonzero(size == length)
        yield int(length), rows, flat[at[:-1][rows][:, None] + np.arange(length)]


def powers(length: int) -> np.ndarray:
    p = np.full(length, _FACTOR, np.uint64)
    p[:1] = 1
    return np.cumprod(p)


def weights(rows: np.ndarray) -> np.ndarray:
    """The terms of the words' polynomials."""
    return (rows.astype(np.uint64) + np.uint64(1)) * powers(rows.shape[1])


@dataclass(frozen=True)
class Shard:
    """The filter of one word length, or of one part of its hash range."""
    length: int
    part: int
    parts: int
    blocks: int
    first: int           # lane where it begins in its pass

    def lanes(self) -> int:
        return self.blocks * LANES


def places(h: np.ndarray, s: Shard) -> tuple[np.ndarray, np.ndarray]:
    """First lane of the block, and 9-bit places within it, packed."""
    low = (h & np.uint64(0xFFFFFFFF)) * np.uint64(s.blocks) >> np.uint64(32)
    return s.first + low.astype(np.int64) * LANES, mix(h ^ _SECOND)


def of_shard(h: np.ndarray, s: Shard) -> np.ndarray:
    return (h >> np.uint64(32)) * np.uint64(s.parts) >> np.uint64(32) == s.part


def probe(h: np.ndarray, s: Shard, bits: np.ndarray) -> np.ndarray:
    """Indices of the hashes that may be in the shard."""
    alive = np.arange(len(h)) if s.parts == 1 else np.flatnonzero(of_shard(h, s))
    lane, spread = places(h[alive], s)
    for k in range(PROBES):
        p = (spread >> np.uint64(9 * k)) & np.uint64(511)
        found = (bits[lane + (p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        alive, lane, spread = alive[found], lane[found], spread[found]
    return alive


def passes(sizes: list[tuple[int, int]], filter_bytes: int = FILTER_BYTES) -> list[list[Shard]]:
    """Shards for (length, words) of a vocabulary, in passes of at most ``filter_bytes``."""
    out, used = [[]], 0
    for length, n in sorted(sizes):
        parts = max(1, -(-n * BITS_PER_WORD // (8 * filter_bytes // 2)))
        blocks = max(1, -(-n * BITS_PER_WORD // (parts * LANES * 64)))
        for part in range(parts):
            if out[-1] and (used + blocks * LANES) * 8 > filter_bytes:
                out.append([])
                used = 0
            out[-1].append(Shard(length, part, parts, blocks, used))
            used += blocks * LANES
    return [p for p in out if p]


def filter_lanes(vocabulary: DataFrame, shards: list[Shard]) -> np.ndarray:
    """The filter of one pass: lanes set by each task, joined by a bitwise or."""
    wanted = {}
    for s in shards:
        wanted.setdefault(s.length, []).append(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lanes, bits = [], []
            for length, _, rows in by_length(b.column(0)):
                h = mix(weights(rows).sum(axis=1) + np.uint64(length))
                for s in wanted.get(length, []):
                    at, spread = places(h[of_shard(h, s)], s)
                    for k in range(PROBES):
                        p = (spread >> np.uint64(9 * k)) & np.uint64(511)
                        lanes.append(at + (p >> np.uint64(6)).astype(np.int64))
                        bits.append(np.uint64(1) << (p & np.uint64(63)))
            if lanes:
                lane, bit = np.concatenate(lanes), np.concatenate(bits)
                order = np.argsort(lane, kind="stable")
                lane, bit = lane[order], bit[order]
                new = np.flatnonzero(np.diff(lane, prepend=-1))
                if len(new):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lane[new]), pa.array(np.bitwise_or.reduceat(bit, new).view(np.int64))],
                        names=["lane", "bits"])

    got = (vocabulary.select("word").mapInArrow(run, "lane long, bits long").groupBy("lane")
           .agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(sum(s.lanes() for s in shards), np.uint64)
    out[np.asarray(got.column("lane").combine_chunks())] = np.asarray(got.column("bits").combine_chunks()).view(np.uint64)
    return out


# ---------------------------------------------------------------- neighbourhoods

def deletions(rows: np.ndarray, shards: list[Shard], bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, letters) of the words without one letter that may be in the shards."""
    length = rows.shape[1]
    step = max(1, BLOCK // length)
    for a in range(0, len(rows), step):
        part = rows[a:a + step]
        terms = weights(part)
        until = np.cumsum(terms, axis=1)
        h = mix((until - terms) + (until[:, -1:] - until) * _INVERSE + np.uint64(length - 1))
        distinct = np.ones(part.shape, bool)          # of equal neighbours only the last one goes
        distinct[:, :-1] = part[:, :-1] != part[:, 1:]
        row, place = np.nonzero(distinct)
        h = h[row, place]
        for s in shards:
            hit = probe(h, s, bits)
            for i in range(0, len(hit), step):
                r, p = row[hit[i:i + step]], place[hit[i:i + step]]
                keep = np.arange(length - 1)[None, :] + (np.arange(length - 1)[None, :] >= p[:, None])
                yield a + r, part[r[:, None], keep]


def replacements(rows: np.ndarray, alphabet: np.ndarray, shards: list[Shard], bits: np.ndarray
                 ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, letters) of the words with one letter replaced by a larger one that may be in the shards."""
    length = rows.shape[1]
    power = powers(length)
    step = max(1, BLOCK // (length * len(alphabet)))
    wide, many = max(1, BLOCK // len(alphabet)), max(1, BLOCK // length)
    for a in range(0, len(rows), step):
        part = rows[a:a + step]
        base = weights(part).sum(axis=1) + np.uint64(length)
        for b in range(0, length, wide):
            some = part[:, b:b + wide]
            row, place, to = np.nonzero(alphabet[None, None, :] > some[:, :, None])
            change = alphabet[to].astype(np.uint64) - some[row, place].astype(np.uint64)
            h = mix(base[row] + change * power[b + place])
            for s in shards:
                hit = probe(h, s, bits)
                for i in range(0, len(hit), many):
                    at = hit[i:i + many]
                    made = part[row[at]]
                    made[np.arange(len(at)), b + place[at]] = alphabet[to[at]]
                    yield a + row[at], made


def candidates(vocabulary: DataFrame, shards: list[Shard], alphabet: np.ndarray) -> DataFrame:
    """(word, n, near) of the edits of all words that pass the filters of ``shards``."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(filter_lanes(vocabulary, shards))
    wanted = {}
    for s in shards:
        wanted.setdefault(s.length, []).append(s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for length, at, rows in by_length(b.column(0)):
                found = []
                if length - 1 in wanted:
                    found.append(deletions(rows, wanted[length - 1], sent.value))
                if length in wanted:
                    found.append(replacements(rows, alphabet, wanted[length], sent.value))
                for made in found:
                    for row, edits in made:
                        if len(row):
                            own = b.take(pa.array(at[row]))
                            yield pa.RecordBatch.from_arrays([own.column(0).cast(pa.string()), own.column(1), spelled(edits)],
                                                             names=["word", "n", "near"])

    return vocabulary.select("word", "n").mapInArrow(run, "word string, n long, near string")


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every unordered pair of near words once. ``vocabulary`` is a
    written table (word, n) of distinct words."""
    sizes = [(r.length, r["count"]) for r in vocabulary.groupBy(F.length("word").alias("length")).count().collect()]
    signs = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    alphabet = np.array(sorted(ord(r.c) for r in signs if r.c), np.uint8)
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    out = None
    for k, shards in enumerate(passes(sizes, filter_bytes)):
        found = stored(candidates(vocabulary, shards, alphabet).join(known, "near"), f"near-words-{k}")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return vocabulary.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    return out.select("word", "n", "near", "near_n")


# ---------------------------------------------------------------- forms and roots

def with_forms(vocabulary: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Adds ``n_near``, ``form`` and ``form_n`` to the vocabulary."""
    both = pairs.select(F.explode(F.array(
        F.struct("word", "near", F.col("near_n").alias("m")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("m")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "near")).alias("top"))
    strong = -F.col("top.m") >= F.col("n") * ratio
    return vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("top.near")).alias("form"), F.when(strong, -F.col("top.m")).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Adds ``root``, the last word along forms; ``forms`` is a written table."""
    links = stored(forms.filter("form is not null").select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = stored(links.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            break
        links = links.drop("moved")
    return forms.join(links.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, thin: int = THIN, ratio: int = RATIO,
             filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs``."""
    vocabulary = stored(word_counts(docs, text_col, id_col, min_length, min_count, thin), "vocabulary")
    forms = stored(with_forms(vocabulary, near_words(vocabulary, filter_bytes), ratio), "word-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


_TABLE = "list_transform(range(256), lambda i: " + "{})".format(
    "list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)")
_STEP = "lambda c, b: xor(c >> 8, crc.t[1 + (xor(c, b) & 255)])"

ORACLES = {"op12_spelling_variants": f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT {_TABLE} AS t),
docs AS MATERIALIZED (
  SELECT doc_id, list_reduce(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', ''), lambda x: CAST(ord(x) AS BIGINT)),
                             {_STEP}, CAST(4294967295 AS BIGINT)) AS state,
         regexp_extract_all(text, '[A-Za-zÀ-ÿ]+') AS runs
  FROM documents, crc),
found AS MATERIALIZED (
  SELECT state, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT state, unnest(runs) AS run FROM docs) GROUP BY ALL HAVING length(run) >= {MIN_LENGTH}),
bytes AS MATERIALIZED (
  SELECT run, flatten(list_transform(string_split(run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [CAST(ord(x) AS BIGINT)]
                                     ELSE [195, CAST(ord(x) AS BIGINT) - 64] END)) AS b
  FROM (SELECT DISTINCT run FROM found)),
summed AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(b, {_STEP}, state), CAST(4294967295 AS BIGINT)) AS h FROM found JOIN bytes USING (run), crc),
vocabulary AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {THIN} = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
                ELSE run END AS word, n FROM summed)
  GROUP BY word HAVING length(word) >= {MIN_LENGTH} AND sum(n) >= {MIN_COUNT}),
cut AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM vocabulary, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocabulary b ON a.rest = b.word),
best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS top, max(m) AS m FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= {RATIO} * v.n THEN b.top END AS form,
         CASE WHEN b.m >= {RATIO} * v.n THEN b.m END AS form_n
  FROM vocabulary v LEFT JOIN best b USING (word)),
walk AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON f.word = w.next)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL"""}
QUERIES = {"op12_spelling_variants": op12_spelling_variants}
