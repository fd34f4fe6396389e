"""Language identification with error-correcting output codes.

Every language gets a codeword of plus and minus ones: with up to ``EXHAUSTIVE`` languages all
distinct splits of the languages in two, beyond that seeded random splits (the draw whose
closest codewords are farthest apart). One binary classifier per bit (hashed
byte n-grams of lower-cased words with their borders, follow-the-regularised-leader) tells the
languages marked plus from those marked minus. Decoding is loss-weighted: a codeword's distance is the
logistic loss of the bits' margins, each bit weighted by how well it was learnt for that
language; the nearest codeword wins, and a text whose second nearest is closer than
``AMBIGUOUS`` is flagged.

Training uses at most ``per_language`` rows a language and ``max_train`` in all (those with the
smallest seeded hashes; a bound on fitting only), whole texts; at most ``max_train`` languages, the
most frequent ones, can be learnt. The bits are dealt to ``GROUPS`` tasks, so a lost
executor repeats its bits only. Prediction covers every row, one scan without a shuffle; each
slice works out the margins of its distinct words and adds them up per text. The model broadcast
is ``bits * 2**18`` floats.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text
if no language was learnt; with one language that one has score 1. Null languages and texts without letters are not
learnt from; rows that repeat are learnt from once; very long texts are handled whole; ties go to
the language that is smaller in code-point order; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fold, mix, per_text, quoted, slices, small_batches, table, words_of
from .linear import DIM, DIM_BITS, Families, ftrl, sparse_rows

PER_LANGUAGE = 500
MAX_TRAIN = 8000
GROUPS = 8
EPOCHS = 3
GRAMS = (1, 2, 3, 4)
EXHAUSTIVE = 5
AMBIGUOUS = 0.1
SALTS = 64
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray         # languages x bits, plus and minus ones
    trust: np.ndarray        # languages x bits, each row sums to 1
    weights: np.ndarray      # slots x bits
    bias: np.ndarray


# ---------------------------------------------------------------- codewords

def codewords(n: int, seed: int = 17, draws: int = 50) -> np.ndarray:
    """``n`` distinct codewords; no bit is constant, none repeats another or its opposite."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        splits = np.arange(1, 1 << (n - 1))
        code = (splits[None, :] >> np.arange(n)[:, None]) & 1
        return np.where(code == 1, -1, 1).astype(np.int8)
    bits, best, apart = math.ceil(10 * math.log2(n)), None, 0
    rng = np.random.default_rng(seed)
    for _ in range(draws if n <= 1000 else 3):
        code = rng.choice(np.array([-1, 1], np.int8), (n, 3 * bits))
        code = np.unique(code * code[:1], axis=1)          # the first language is always plus
        code = code[:, (code < 0).any(axis=0)]
        code = code[:, rng.permutation(code.shape[1])[:bits]]
        least = min(int((code[i] != code[i + 1:]).sum(axis=1).min()) for i in range(n - 1))
        if best is None or least > apart:
            best, apart = code, least
    return best


# ---------------------------------------------------------------- features

def distinct_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words (lower case, without outer signs), each occurrence's index, offsets per text."""
    flat, starts = words_of(texts)
    d = flat.dictionary_encode()
    core = pc.utf8_lower(pc.replace_substring_regex(d.dictionary, r"^[^\p{L}]+|[^\p{L}]+$", ""))
    e = core.dictionary_encode()
    code = np.asarray(e.indices, dtype=np.int64)[np.asarray(d.indices, dtype=np.int64)]
    return e.dictionary, code, starts


def word_grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams of every word between two blanks, and the offsets per word;
    an empty word has none."""
    framed = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words.cast(pa.large_string()),
                                         pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    _, offsets, data = framed.buffers()
    n = len(framed)
    at = np.frombuffer(offsets, np.int64)[framed.offset:framed.offset + n + 1] if n else np.zeros(1, np.int64)
    buf = (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8))[at[0]:at[-1]].astype(np.uint64)
    at = at - at[0]
    size = np.diff(at)
    hashes, owners = [], []
    value = np.zeros(len(buf), np.uint64)
    for k in range(1, max(GRAMS) + 1):
        if len(buf) < k:
            break
        value = value[:len(buf) - k + 1] | buf[k - 1:] << np.uint64(8 * (k - 1))
        if k not in GRAMS:
            continue
        owner = np.repeat(np.arange(n), np.where(size > 2, np.maximum(size - k + 1, 0), 0))
        first = np.concatenate(([0], np.cumsum(np.where(size > 2, np.maximum(size - k + 1, 0), 0))))
        place = np.arange(len(owner)) - first[owner] + at[owner]
        hashes.append(mix(value[place] + (np.uint64(k) << np.uint64(40))))
        owners.append(owner)
    owner = np.concatenate([np.zeros(0, np.int64), *owners])
    order = np.argsort(owner, kind="stable")
    return (np.concatenate([np.zeros(0, np.uint64), *hashes])[order],
            np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))))


def spread(hashes: np.ndarray, starts: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words ``code``, one word after the other, and their offsets."""
    size = np.diff(starts)[code]
    first = np.concatenate(([0], np.cumsum(size)))
    at = np.arange(first[-1]) + np.repeat(starts[:-1][code] - first[:-1], size)
    return hashes[at], first


def text_grams(texts: pa.Array) -> Families:
    """All n-grams of every text, for training."""
    words, code, starts = distinct_words(texts)
    hashes, first = spread(*word_grams(words), code)
    return [(hashes, first[starts])]


def margins(texts: pa.Array, model: Model) -> np.ndarray:
    """Texts x bits: bias + the mean weight of all n-grams, through the distinct words."""
    words, code, starts = distinct_words(texts)
    hashes, first = word_grams(words)
    slot = (hashes >> np.uint64(64 - DIM_BITS)).astype(np.int64)
    size = np.diff(first)
    per_word = np.zeros((len(size), len(model.bias)))
    full = np.flatnonzero(size)
    if len(full):
        per_word[full] = np.add.reduceat(model.weights[slot].astype(np.float64), first[:-1][full], axis=0)
    text, n = per_text(starts), len(starts) - 1
    grams = np.bincount(text, size[code], n)
    out = np.empty((n, len(model.bias)))
    for b in range(len(model.bias)):
        out[:, b] = np.bincount(text, per_word[code, b], n) / np.maximum(grams, 1) + model.bias[b]
    return out


def has_letter(texts: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(texts, r"\p{L}"))


# ---------------------------------------------------------------- training

def training_rows(docs: DataFrame, text_col: str, lang_col: str, id_col: str, learn: Column, per_language: int,
                  max_train: int) -> tuple[DataFrame, list[str]]:
    """The rows (text, lang) to learn from, and their languages in order."""
    rows = docs.filter(learn).select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).alias("text"),
                                     quoted(id_col).cast("string").alias("id")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("draw", F.xxhash64("id", "lang", "text", F.lit(13)))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_train).collect()
    languages = sorted(r.lang for r in counts)
    each = max(1, min(per_language, max_train // max(len(languages), 1)))
    # the cut-off of every language, first among parts of its rows: no language meets in one task whole
    small = Window.partitionBy("lang", "salt").orderBy("draw")
    whole = Window.partitionBy("lang").orderBy("draw")
    cut = (rows.select("lang", "draw", F.pmod("draw", F.lit(SALTS)).alias("salt"))
           .withColumn("rank", F.dense_rank().over(small)).filter(F.col("rank") <= each)
           .withColumn("rank", F.dense_rank().over(whole)).filter(F.col("rank") <= each)
           .groupBy("lang").agg(F.max("draw").alias("cut")).orderBy("lang"))
    kept = spark_rows(docs.sparkSession, [(r.lang, r.cut) for r in cut.collect() if r.lang in set(languages)])
    chosen = rows.join(F.broadcast(kept), "lang").filter("draw <= cut").dropDuplicates(["lang", "draw"])
    return chosen.select("text", "lang", "draw"), languages


def spark_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "lang string, cut long")


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          per_language: int = PER_LANGUAGE, max_train: int = MAX_TRAIN, epochs: int = EPOCHS) -> Model:
    """The model learnt from the rows for which ``learn`` holds."""
    small_batches(docs.sparkSession)
    rows, languages = training_rows(docs, text_col, lang_col, id_col, learn, per_language, max_train)
    code = codewords(len(languages))
    bits = code.shape[1]
    groups = max(1, min(GROUPS, bits))
    index = {lang: i for i, lang in enumerate(languages)}

    def fit(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("draw", "ascending"), ("lang", "ascending")])
        features = []
        for _, texts in slices(iter(group.select(["text"]).to_batches())):
            features += sparse_rows(text_grams(texts), presence=False)
        features = [(i, x * np.float32(100)) for i, x in features]
        lang = np.array([index[x] for x in group.column("lang").to_pylist()])
        out = []
        for b in range(key[0].as_py(), bits, groups):
            y = (code[lang, b] > 0).astype(np.float64)
            w, bias = ftrl(features, y, epochs, alpha=0.2, beta=0.5, l1=0.02, l2=1e-3, seed=b)
            right = np.array([(w[i] @ x + bias > 0) for i, x in features]) == (y > 0)
            good = np.bincount(lang, right, len(languages)) / np.maximum(np.bincount(lang, minlength=len(languages)), 1)
            out.append((b, (w * 100).astype(np.float32).tobytes(), float(bias), good.tolist()))
        return pa.table({"bit": pa.array([r[0] for r in out], pa.int32()), "w": pa.array([r[1] for r in out], pa.binary()),
                         "bias": pa.array([r[2] for r in out], pa.float64()),
                         "good": pa.array([r[3] for r in out], pa.list_(pa.float64()))})

    model = Model(languages, code, np.zeros((len(languages), bits)), np.zeros((DIM, bits), np.float32), np.zeros(bits))
    if not bits:
        return model
    parts = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    for r in parts.groupBy("part").applyInArrow(fit, "bit int, w binary, bias double, good array<double>").collect():
        model.weights[:, r.bit] = np.frombuffer(r.w, np.float32)
        model.bias[r.bit], model.trust[:, r.bit] = r.bias, r.good
    model.trust /= np.maximum(model.trust.sum(axis=1, keepdims=True), 1e-9)
    return model


# ---------------------------------------------------------------- decoding

def decode(f: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(best, second, score, distance between them) of every text from its margins."""
    n, k = len(f), len(model.languages)
    if k == 1:
        none = np.full(n, -1)
        return np.zeros(n, np.int64), none, np.ones(n), np.full(n, np.inf)
    plus, minus = np.logaddexp(0, -f), np.logaddexp(0, f)
    up = model.trust * (model.code > 0)
    loss = plus @ up.T + minus @ (model.trust - up).T
    order = np.argsort(loss, axis=1, kind="stable")
    best, second = order[:, 0], order[:, 1]
    at = np.arange(n)
    like = np.exp(-(loss - loss[at, best][:, None]) * model.code.shape[1])
    return best, second, 1 / like.sum(axis=1), loss[at, second] - loss[at, best]


def predict(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score, runner_up, ambiguous) of every row: one scan, no shuffle."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = np.array([*m.languages, None], object)
        for rows, texts in slices(batches):
            n = rows.num_rows
            lang, second = np.full(n, UNKNOWN, object), np.full(n, None, object)
            score, gap = np.zeros(n), np.full(n, np.inf)
            some = has_letter(texts) if m.languages else np.zeros(n, bool)
            if some.any():
                best, other, p, away = decode(margins(texts.filter(pa.array(some)), m), m)
                lang[some], second[some], score[some], gap[some] = names[best], names[other], p, away
            yield pa.RecordBatch.from_arrays(
                [rows.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(second, pa.string()),
                 pa.array(gap < AMBIGUOUS)], names=["id", "lang_pred", "score", "runner_up", "ambiguous"])

    kept = docs.select(quoted(text_col).alias("_text"), quoted(id_col).alias("id"))
    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"id {kind}, lang_pred string, score double, runner_up string, ambiguous boolean"
                           ).withColumnRenamed("id", id_col)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, fold("doc_id", 4) != 2)
    return predict(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score",
                                       "runner_up", "ambiguous")


QUERIES = {"op13_language_id": op13_language_id}
