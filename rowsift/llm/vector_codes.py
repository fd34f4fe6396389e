"""Vector compression: product codes whose nearest entries are found by equal-average search.

A vector is quantised to integers ``floor(scale * x)`` and cut into ``parts`` equal
consecutive parts; each part is replaced by the index of the nearest entry of the codebook
of its position (squared Euclidean distance, ties to the lower index). A codebook starts
as the parts of the ``entries`` smallest ids and is refined in ``rounds`` rounds (assign
every part, replace each used entry by the componentwise floor of its parts' mean).

Equal-average search: entries are sorted by the sum of their components. For vectors of
``d`` components, ``(sum(x) - sum(y))**2 / d`` never exceeds the squared distance, so
the search starts at a part's own sum and expands outward on both sides until the squared
gap over ``d`` strictly exceeds the best distance so far (strictly, so that no tie is
lost). Parts are handled in runs of neighbouring sums and entries in runs of ``STEP``, so
that distances are products of small matrices; all are exact integers.

What moves: per round each task sends one (count, sums) row per used entry, added up by
Spark to ``parts * entries * d`` numbers, whatever the number of vectors. The codebooks are
all that reaches the driver or is broadcast. Labels that hold more than 1 in ``HEAVY`` rows (at
most ``HEAVY`` labels) are joined by a broadcast, the others by a shuffle.

Defined cases: a vector that is null or holds null or non-finite components is
dropped. A vector whose length differs from that of the smallest id's vector (the larger, if
an id has vectors of several lengths) is kept with null code and error. That length must be a multiple of
``parts`` (else ``ValueError``); empty vectors have code 0 and error 0. Rows with a null id
are coded but start no entry; an id with several vectors starts one entry with its
smallest vector; repeated rows count each. With fewer ids than ``entries`` the codebooks are
smaller. Null labels are one label. Components of which a squared distance would leave 64
bits raise ``OverflowError``. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, small_batches, stored, table

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
HEAVY = 1000
STEP = 16             # entries compared at a time
RUN = 256             # parts of neighbouring sums searched together
EXACT = 1 << 53       # integers that doubles hold exactly


def integers(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows to keep, and their components as integers with the offsets per kept row."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    length = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0), dtype=np.int64)
    flat = pc.list_flatten(vectors).cast(pa.float64())
    x = np.asarray(pc.fill_null(flat, float("nan")))
    owner = np.repeat(np.arange(len(length)), length)
    keep = np.asarray(pc.is_valid(vectors)).copy()
    keep[owner[~np.isfinite(x)]] = False
    x = np.floor(x[keep[owner]] * scale)
    if len(x) and np.abs(x).max() > 2.0**62:
        raise OverflowError("a component leaves 64 bits")
    return keep, x.astype(np.int64), np.concatenate(([0], np.cumsum(length[keep])))


def matrix(x: np.ndarray, offsets: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``dim`` components as a matrix, and which rows they are."""
    fits = np.diff(offsets) == dim
    if fits.all():
        return x.reshape(len(fits), dim), fits
    at = offsets[:-1][fits][:, None] + np.arange(dim)
    return x[at].reshape(int(fits.sum()), dim), fits


def nearest(x: np.ndarray, book: np.ndarray, step: int = STEP, run: int = RUN
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of the nearest entry of ``book`` for every row of ``x``,
    ties to the lower index, and the number of distances taken."""
    n, d = x.shape
    index, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if not n or not d:
        return index, best, 0
    high = int(max(np.abs(x).max(), np.abs(book).max()))
    if 4 * d * high * high >= 1 << 63:
        raise OverflowError("a squared distance leaves 64 bits")
    kind = np.float64 if 4 * d * high * high < EXACT else np.int64
    sums, order = x.sum(axis=1), np.argsort(book.sum(axis=1), kind="stable")
    entry_sums = book.sum(axis=1)[order].astype(np.float64)
    entries = book[order].astype(kind)
    squares = (entries * entries).sum(axis=1)
    rows, taken = np.argsort(sums, kind="stable"), 0
    for a in range(0, n, run):
        at = rows[a:a + run]
        part, s = x[at].astype(kind), sums[at].astype(np.float64)
        own = (part * part).sum(axis=1)
        least = np.full(len(at), np.iinfo(np.int64).max)
        place = np.full(len(at), len(book))
        middle = int(np.searchsorted(entry_sums, (s[0] + s[-1]) / 2))
        left = right = min(max(middle - step // 2, 0), len(book) - 1)

        def compare(lo, hi, who):
            got = (own[who, None] - 2 * (part[who] @ entries[lo:hi].T) + squares[lo:hi]).astype(np.int64)
            low = got.min(axis=1)
            first = np.where(got == low[:, None], order[lo:hi], len(book)).min(axis=1)
            better = (low < least[who]) | ((low == least[who]) & (first < place[who]))
            least[who] = np.where(better, low, least[who])
            place[who] = np.where(better, first, place[who])
            return got.size

        while left > 0 or right < len(book):
            # rounded gaps are taken a little smaller, so that no tie is passed over
            if right < len(book):
                gap = np.maximum(entry_sums[right] - s, 0)
                who = np.flatnonzero(gap * gap * (1 - 1e-12) <= d * least.astype(np.float64))
                if len(who):
                    taken += compare(right, min(right + step, len(book)), who)
                    right = min(right + step, len(book))
                else:
                    right = len(book)
            if left > 0:
                gap = np.maximum(s - entry_sums[left - 1], 0)
                who = np.flatnonzero(gap * gap * (1 - 1e-12) <= d * least.astype(np.float64))
                if len(who):
                    taken += compare(max(left - step, 0), left, who)
                    left = max(left - step, 0)
                else:
                    left = 0
        index[at], best[at] = place, least
    return index, best, taken


def first_vectors(vectors: DataFrame, entries: int = ENTRIES, scale: int = SCALE) -> list[np.ndarray]:
    """Vectors of the ``entries`` smallest ids, in order (each task sends at most as many)."""
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, kind = {}, None
        for b in batches:
            kind = b.column(0).type
            keep, x, at = integers(b.column(1), scale)
            ids = b.column(0).filter(pa.array(keep))
            for row in np.asarray(pc.array_sort_indices(ids)):
                i = ids[int(row)].as_py()
                if i is None or (len(best) >= entries and i not in best and i > max(best)):
                    break
                v = x[at[row]:at[row + 1]].tolist()
                if i not in best or (-len(v), v) < (-len(best[i]), best[i]):
                    best[i] = v
                if len(best) > entries:
                    del best[max(best)]
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), kind), pa.array([-len(v) for v in best.values()], pa.int64()),
                 pa.array(list(best.values()), pa.list_(pa.int64()))], names=["id", "n", "v"])

    kind = vectors.schema["id"].dataType.simpleString()
    got = (vectors.mapInArrow(smallest, f"id {kind}, n long, v array<long>").groupBy("id")
           .agg(F.min(F.struct("n", "v")).alias("b")).orderBy("id").limit(entries).select("b.v").collect())
    return [np.array(r.v, np.int64) for r in got]


def assign(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, error per part) of the rows of ``x``, each of shape (rows, parts)."""
    width = books[0].shape[1]
    found = [nearest(x[:, p * width:(p + 1) * width], book) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def refined(vectors: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> list[np.ndarray]:
    """One round: every entry that has parts becomes the floor of their mean."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)
    count, width = len(books[0]), books[0].shape[1]
    dim = width * len(books)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(sent.value) * count, np.int64)
        total = np.zeros((len(n), width), np.int64)
        for b in batches:
            _, x, at = integers(b.column(1), scale)
            x, _ = matrix(x, at, dim)
            codes, _ = assign(x, sent.value)
            for p in range(codes.shape[1]):
                n += np.bincount(codes[:, p] + p * count, minlength=len(n))
                np.add.at(total, codes[:, p] + p * count, x[:, p * width:(p + 1) * width])
        used = np.flatnonzero(n)
        slot = (used[:, None] * width + np.arange(width)).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(np.repeat(n[used], width)), pa.array(total[used].ravel())],
            names=["slot", "n", "total"])

    sums = (vectors.mapInArrow(add, "slot long, n long, total long").groupBy("slot")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow())
    flat = np.concatenate([b.ravel() for b in books])
    slot, n, total = (np.asarray(sums.column(c).combine_chunks()) for c in ("slot", "n", "total"))
    flat[slot] = total // n          # rounds down, below zero too
    sent.unpersist()
    return [b.reshape(count, width) for b in np.split(flat, len(books))]


def learn(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> list[np.ndarray] | None:
    """Codebooks of every part position; None without a vector that has an id."""
    first = first_vectors(vectors, entries, scale)
    if not first:
        return None
    dim = len(first[0])
    if dim % parts:
        raise ValueError(f"{dim} components do not make {parts} equal parts")
    start = np.stack([v for v in first if len(v) == dim])
    books = [np.ascontiguousarray(b) for b in np.split(start, parts, axis=1)]
    for _ in range(rounds if dim else 0):
        books = refined(vectors, books, scale)
    return books


def digest(books: list[np.ndarray]) -> str:
    """sha256 of all entries' components in decimal by part, entry and position."""
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray] | None, scale: int = SCALE) -> DataFrame:
    """(id, label, code, error) of every kept row; one scan, no shuffle."""
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, x, at = integers(b.column(1), scale)
            rows = b.filter(pa.array(keep))
            code, error = np.full(rows.num_rows, None, object), np.zeros(rows.num_rows, np.int64)
            fits = np.zeros(rows.num_rows, bool)
            if sent.value is not None:
                x, fits = matrix(x, at, sum(b.shape[1] for b in sent.value))
                codes, errors = assign(x, sent.value)
                digits = max(2, len(f"{max(len(sent.value[0]) - 1, 0):x}"))
                code[fits] = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
                error[fits] = errors.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(code, pa.string()), pa.array(error, mask=~fits)],
                names=["id", "label", "code", "error"])

    kinds = {c: vectors.schema[c].dataType.simpleString() for c in ("id", "label")}
    return vectors.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over equal labels; ``coded`` is a written table."""
    per = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows")),
                 "label-errors")
    total = per.agg(F.sum("rows")).first()[0] or 0
    heavy = F.broadcast(per.filter(F.col("rows") * HEAVY > total).select(
        F.col("label").alias("_label"), "label_error", F.lit(True).alias("heavy")))
    same = F.col("label").eqNullSafe(F.col("_label"))
    found = coded.join(heavy, same, "left")
    hot = found.filter("heavy").drop("_label", "heavy")
    light = per.filter(F.col("rows") * HEAVY <= total).select(F.col("label").alias("_label"), "label_error")
    rest = found.filter("heavy is null").drop("_label", "heavy", "label_error").join(light, same, "left")
    return hot.unionByName(rest.drop("_label"))


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
             ) -> tuple[DataFrame, list[np.ndarray] | None]:
    """(id, label, code, error) of every kept row as a written table, and the codebooks."""
    small_batches(df.sparkSession)
    vectors = df.select(quoted(id_col).alias("id"), quoted(vector_col).alias("v"), quoted(label_col).alias("label"))
    if not isinstance(vectors.schema["v"].dataType, T.ArrayType):
        raise TypeError("vectors must be arrays of numbers")
    books = learn(vectors, parts, entries, rounds, scale)
    return stored(encode(vectors, books, scale), "vector-codes"), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return with_label_error(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(digest(books) if books else None).cast("string").alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codes from all distances, round after round."""
    def assigned(book: str) -> str:
        return f"""SELECT vec_id, part, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (
          SELECT p.vec_id, p.part, b.entry,
                 list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dist
          FROM pieces p JOIN {book} b USING (part)) GROUP BY vec_id, part"""

    steps = [f"""whole AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
        AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0)""",
             f"""pieces AS MATERIALIZED (
      SELECT vec_id, label, CAST(p.range AS INTEGER) AS part,
             list_slice(v, 1 + p.range * (len(v) // {parts}), (p.range + 1) * (len(v) // {parts})) AS v
      FROM whole, range({parts}) p)""",
             f"""b0 AS MATERIALIZED (
      SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS entry, v FROM pieces
      WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {entries}))"""]
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({assigned(f'b{r}')})")
        steps.append(f"""b{r + 1} AS MATERIALIZED (
      SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN (
        SELECT part, entry, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS v FROM (
          SELECT a.part, a.entry, i, sum(p.v[i]) AS total, count(*) AS n
          FROM a{r} a JOIN pieces p USING (vec_id, part), LATERAL (SELECT unnest(range(1, len(p.v) + 1)) AS i)
          GROUP BY a.part, a.entry, i) GROUP BY part, entry) m USING (part, entry))""")
    return "WITH " + ",\n".join(steps) + f""",
last AS MATERIALIZED ({assigned(f'b{rounds}')}),
codes AS (SELECT w.vec_id, any_value(w.label) AS label, string_agg(printf('%02x', l.entry), '' ORDER BY l.part) AS code,
                 CAST(sum(l.dist) AS BIGINT) AS error
          FROM whole w JOIN last l USING (vec_id) GROUP BY w.vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM codes"""


QUERIES = {"op11_vector_codes": op11_vector_codes}
ORACLES = {"op11_vector_codes": _sql()}
