"""Codewords, margins against dictionaries, held-out accuracy, odd texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from rowsift.llm import language_id as L
from rowsift.llm.common import fold
from rowsift.llm.linear import DIM_BITS


@pytest.mark.parametrize("n", [2, 3, 4, 5, 6, 20, 150])
def test_codewords_are_far_apart(n):
    code = L.codewords(n)
    assert set(np.unique(code)) <= {-1, 1} and len(np.unique(code, axis=0)) == n
    columns = {tuple(c * c[0]) for c in code.T}
    assert len(columns) == code.shape[1] and all(len(set(c)) == 2 for c in columns)
    apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert apart >= (1 if n == 2 else 2 if n == 3 else code.shape[1] // 4)


def test_one_wrong_bit_is_corrected():
    code = L.codewords(4)
    m = L.Model(list("abcd"), code, np.full(code.shape, 1 / code.shape[1]), None, None)
    for lang in range(4):
        for bit in range(code.shape[1]):
            f = 3.0 * code[lang]
            f[bit] *= -1
            best, _, score, _ = L.decode(f[None, :], m)
            assert best[0] == lang and 0.5 < score[0] <= 1


def test_untrusted_bits_weigh_less():
    code = L.codewords(4)
    trust = np.ones(code.shape)
    good = np.isin(np.arange(7), [0, 1, 3])                  # the bits that tell each of the first three from the rest
    trust[:, ~good] = 1e-6
    f = np.where(good, 2.0, -2.0) * code[2]      # four wrong bits that no language trusts
    m = L.Model(list("abcd"), code, trust / trust.sum(axis=1, keepdims=True), None, None)
    assert L.decode(f[None, :], m)[0][0] == 2


def slot(gram):
    x = np.array([int.from_bytes(gram, "little") + (len(gram) << 40)], np.uint64)
    return int(L.mix(x)[0] >> np.uint64(64 - DIM_BITS))


def test_margins_equal_a_sum_over_all_grams():
    rng = np.random.default_rng(3)
    m = L.Model(["x", "y"], L.codewords(3), None, rng.normal(size=(L.DIM, 3)).astype(np.float32), rng.normal(size=3))
    texts = ["The Cat, the cat!", "", "...", "Été (été) naïve 12 x", "a", "z" * 5000, "你好 你"]
    got = L.margins(pa.array(texts, pa.large_string()), m)
    for t, row in zip(texts, got):
        grams = Counter()
        for word in t.split():
            word = re.sub(r"^[\W\d_]+|[\W\d_]+$", "", word.lower())
            b = f" {word} ".encode()
            if word:
                grams.update(b[i:i + k] for k in L.GRAMS for i in range(len(b) - k + 1))
        total = sum(grams.values())
        want = m.bias + sum(n * m.weights[slot(g)].astype(float) for g, n in grams.items()) / max(total, 1)
        assert np.allclose(row, want, atol=1e-6)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = L.op13_language_id(spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = out.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) > 0.99 * len(held)
    assert {r.lang_pred for r in rows} <= {r.lang for r in rows}


def test_held_out_rows_and_other_columns_teach_nothing(spark, edge_docs):
    docs = edge_docs.withColumn("lang", F.when(fold("doc_id", 4) == 2, "hidden").otherwise(F.when(F.length("text") % 2 == 0, "p").otherwise("q")))
    model = L.train(docs, fold("doc_id", 4) != 2)
    assert model.languages == ["p", "q"]
    first = L.predict(docs, model).collect()
    assert len(first) == docs.count() and {r.lang_pred for r in first} <= {"p", "q", "und"}
    again = L.predict(docs.withColumn("source", F.lit("z")).withColumn("score", F.lit("s")), model).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    for r in first:
        assert (r.lang_pred == "und") == (r.doc_id in (30, 31, 32) or (r.doc_id is None and r.score == 0))


def test_no_one_and_many_languages(spark, edge_docs, no_docs):
    for docs in (no_docs, edge_docs):
        model = L.train(docs, F.lit(True))              # lang is null everywhere
        assert model.languages == [] and {r.lang_pred for r in L.predict(edge_docs, model).collect()} == {"und"}
    one = L.train(edge_docs.withColumn("lang", F.lit("x")), F.lit(True))
    assert {(r.lang_pred, r.score) for r in L.predict(edge_docs, one).collect()} == {("x", 1.0), ("und", 0.0)}
    assert L.predict(no_docs, one).count() == 0
    rows = [(i, f"{'abcdefghijkl'[i % 12] * 3}{'mnopqr'[i % 6]} " * 8, f"l{i % 12:02d}") for i in range(480)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs, F.col("doc_id") % 2 < 2, per_language=20)
    got = L.predict(docs, model).collect()
    assert sum(r.lang_pred == f"l{r.doc_id % 12:02d}" for r in got) == 480


def test_training_rows_are_the_smallest_hashes_of_each_language(spark):
    df = spark.range(3000).selectExpr("id doc_id", "concat('t', id) text", "if(id % 3 < 2, 'big', 'small') lang").repartition(5)
    rows, languages = L.training_rows(df.union(df.limit(50)), "text", "lang", "doc_id", F.lit(True), 100, 8000)
    assert languages == ["big", "small"]
    got = {(r.lang, r.draw) for r in rows.collect()}
    every = df.select("lang", F.xxhash64(F.col("doc_id").cast("string"), "lang", "text", F.lit(13)).alias("draw")).collect()
    want = {(x, d) for x in languages for d in sorted(r.draw for r in every if r.lang == x)[:100]}
    assert got == want and rows.count() == 200
    assert math.isclose(rows.filter("lang = 'big'").count(), 100)
