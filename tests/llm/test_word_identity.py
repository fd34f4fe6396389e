"""Long words whose polynomials modulo 2**64 are equal for any odd factor stay different words."""

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowsift.llm import lm_scoring, near_dedup, packing, token_counts
from rowsift.llm.common import hash_texts, span_hashes, word_spans

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def pair(bits, a="ab", b="xy"):
    """Two words of 2**bits letters in the order of the parity of the positions' binary ones."""
    ones = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join(a[k] for k in ones), "".join(a[1 - k] for k in ones)


@pytest.mark.parametrize("bits", [9, 10, 11, 12])
def test_hashes_differ(bits):
    one, two = pair(bits)
    h = hash_texts([one, two, one])
    assert h[0] != h[1] and h[0] == h[2]
    buf, begin, end, _ = word_spans(pa.array([f"x {two} {one}", one], pa.large_string()))
    assert span_hashes(buf, begin, end)[1:].tolist() == [h[1], h[0], h[0]]


def test_four_operators_tell_them_apart(spark):
    one, two = pair(10)
    rows = [(i, " ".join([one if i % 2 else two] * 3 + [f"word{i}", "end"])) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tok = Tokenizer.from_file(TOKENIZER)
    want = {i: tok.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert want[0][:200] != want[1][:200]
    counts = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, TOKENIZER).collect()}
    assert counts == {i: len(x) for i, x in want.items()}
    pieces = {(r.doc_id, r.piece): r.length for r in packing.pack(docs, TOKENIZER).collect()}
    assert {i: sum(n for (d, _), n in pieces.items() if d == i) for i in want} == {i: len(x) + 1 for i, x in want.items()}
    s, _, at = near_dedup.shingles(pa.array([" ".join([w] * 6) for w in (one, two)], pa.large_string()))
    assert set(s[at[0]:at[1]].tolist()).isdisjoint(s[at[1]:at[2]].tolist())
    scored = {r.doc_id: r for r in lm_scoring.lm_scores(docs, F.col("doc_id") < 4).collect()}
    known = {i: len(t.split()) + 1 for i, t in rows if i < 4}
    assert {i: scored[i].n_known for i in known} == known and scored[0].train_tokens == sum(known.values())


def test_packed_planes_and_word_steps():
    rng = np.random.default_rng(5)
    for kind in (np.uint64, np.int64, np.uint32, np.float32, np.uint8):
        for size in (0, 1, 1000):
            x = (rng.random(size) * 200).astype(kind)
            for planes in (False, True):
                assert (lm_scoring.joined(pa.chunked_array([lm_scoring.column_of([x], planes)]), kind) == x).all()
    small = rng.integers(0, 100, 5000)
    assert len(lm_scoring.packed(small, True)) < 0.8 * len(lm_scoring.packed(small))
    runs, words = np.array([2, 0, 3, 1]), np.array([4, 9, 1, 5, 8, 3])
    assert (lm_scoring.asked_words_of(np.array([4, 5, 1, 4, 3, 3]), runs) == words).all()
    keys = rng.integers(0, 50, 400)
    for limit in (50, 1 << 62):
        order, new = lm_scoring.grouped(keys, limit)
        assert (order == np.argsort(keys, kind="stable")).all() and new.sum() == len(np.unique(keys))
