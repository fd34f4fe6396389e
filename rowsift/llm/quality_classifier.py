"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Features of a text: hashed one- and two-word n-grams of the words (lower case, without outer
punctuation) and one-, two- and three-word n-grams of the words' shapes (letters,
digits and punctuation classes, and whether the word equals the one before).

Training uses at most ``max_train`` labelled rows (the ids with the smallest
seeded hashes; a bound on fitting only), with whole texts, dealt to ``replicas``
groups; each group trains its own model for ``epochs`` passes, and the weights
are averaged, so a lost executor repeats one group only. Scoring covers every
row, one scan without a shuffle; the model broadcast is ``2**18`` floats.

Defined cases: null and empty texts have no features and get the logistic of
the bias; null ids are scored and never used for training; null labels are not used;
an id labelled twice trains with its smallest label, an id with several texts
with its smallest text; without labels every score is 0.5; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, give_back, hash_words, keep_rows, mix, per_text, quoted, slices, small_batches, table, words_of
from .linear import DIM, Families, ftrl, logistic, margins, sparse_rows

MAX_TRAIN = 8000
REPLICAS = 4
EPOCHS = 4
THRESHOLD = 0.3


def ngrams(h: np.ndarray, starts: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-grams within each text and their offsets."""
    n = np.maximum(np.diff(starts) - (k - 1), 0)
    offsets = np.concatenate(([0], np.cumsum(n)))
    if not len(h) or not offsets[-1]:
        return np.zeros(0, np.uint64), offsets
    out = np.full(max(len(h) - k + 1, 0), np.uint64(seed * 2 + 1))
    for j in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j])
    text = per_text(starts)
    return out[text[:len(out)] == text[k - 1:]], offsets


def quality_features(texts: pa.Array) -> Families:
    flat, starts = words_of(texts)
    d = flat.dictionary_encode()
    words, codes = d.dictionary, np.asarray(d.indices, dtype=np.int64)

    def hashed(values: pa.Array, seed: int) -> np.ndarray:
        e = values.dictionary_encode()
        return hash_words(e.dictionary.to_pylist(), seed)[np.asarray(e.indices, dtype=np.int64)]

    core = pc.utf8_lower(pc.replace_substring_regex(words, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    shape = words
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}]+", "a"), (r"\p{N}+", "0")):
        shape = pc.replace_substring_regex(shape, pattern, sign)
    shape = pc.utf8_slice_codeunits(shape, 0, 12)
    h = hashed(core, 1)[codes] if len(codes) else np.zeros(0, np.uint64)
    s = hashed(shape, 2)[codes] if len(codes) else np.zeros(0, np.uint64)
    if len(codes):
        same = np.concatenate(([0], (codes[1:] == codes[:-1]).astype(np.uint64)))
        same[starts[:-1][starts[:-1] < len(codes)]] = 0
        s = mix(s + same.astype(np.uint64))
    return [ngrams(h, starts, 1, 1), ngrams(h, starts, 2, 2),
            ngrams(s, starts, 1, 3), ngrams(s, starts, 2, 4), ngrams(s, starts, 3, 5)]


def bounded_labels(labels: DataFrame, id_col: str, label_col: str, max_train: int) -> DataFrame:
    """At most ``max_train`` training rows (id, label), chosen by a seeded hash of the id."""
    return (labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("double").alias("label"))
            .filter("id is not null and label is not null").groupBy("id").agg(F.min("label").alias("label"))
            .orderBy(F.xxhash64("id", F.lit(11)), "id").limit(max_train))


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
          label_col: str = "quality", max_train: int = MAX_TRAIN, replicas: int = REPLICAS,
          epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Averaged weights and bias. ``labels``: rows that may be learnt from."""
    chosen = bounded_labels(labels, id_col, label_col, max_train)
    rows = (docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "id").groupBy("id")
            .agg(F.min("text").alias("text"), F.min("label").alias("label"))
            .withColumn("replica", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(replicas)).cast("int")))

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        out = []
        for _, texts in slices(iter(group.select(["text"]).to_batches())):
            out += sparse_rows(quality_features(texts), presence=False)
        w, b = ftrl(out, np.asarray(group.column("label")), epochs, alpha=0.5, beta=1.0, l1=0.02, l2=1e-4)
        at = np.flatnonzero(w)
        out.clear()
        give_back()
        return pa.table({"slot": pa.array(np.append(at, DIM), pa.int64()),
                         "w": pa.array(np.append(w[at], b), pa.float64())})

    groups = rows.groupBy("replica")
    models = groups.applyInArrow(fit, "slot long, w double").groupBy("slot").agg(
        F.sum("w").alias("w"), F.count("*").alias("n")).collect()
    weights = np.zeros(DIM + 1)
    made = next((r.n for r in models if r.slot == DIM), 1)
    for r in models:
        weights[r.slot] = r.w / made
    return weights[:DIM].astype(np.float32), float(weights[DIM])


def score(docs: DataFrame, weights: np.ndarray, bias: float, text_col: str = "text",
          id_col: str = "doc_id") -> DataFrame:
    """(id, score) of every row: one scan, no shuffle."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = model.value
        for rows, texts in slices(batches):
            s = logistic(margins(quality_features(texts), w, b, presence=False))
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(s)],
                                             names=[*rows.schema.names[1:], "score"])

    kept = docs.select(quoted(text_col).alias("_text"), quoted(id_col).alias("id"))
    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, weights: np.ndarray, bias: float, threshold: float = THRESHOLD,
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more; all columns stay."""
    model = docs.sparkSession.sparkContext.broadcast((weights, bias))

    def decide(texts: pa.Array) -> np.ndarray:
        w, b = model.value
        return logistic(margins(quality_features(texts), w, b, presence=False)) >= threshold

    return keep_rows(docs, text_col, decide)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id") != 0)
    scored = score(docs, *train(docs, labels))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op1_quality": op1_quality}
