"""Token counts and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowsift.llm.common import hash_texts, span_hashes, word_spans
from rowsift.llm.packing import pack, plan_bins, sequences
from rowsift.llm.token_counts import count_tokens, frequent_words, op10_token_counts
from rowsift.llm.tokenizer import WordTable, encoder, splits_at_space

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_counts_of_edge_cases(spark, edge_docs, no_docs, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in count_tokens(edge_docs, PATH).collect())
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()), len(ids(library, r.text)))
                  for r in edge_docs.collect())
    assert got == want
    assert count_tokens(no_docs, PATH).count() == 0


def test_counts_do_not_depend_on_the_table(spark, edge_docs):
    def run(size):
        return sorted((r.n_bytes, r.n_tokens) for r in count_tokens(edge_docs, PATH, table_size=size).collect())
    assert run(1) == run(50_000)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_other_tokenizers_get_whole_texts(spark, prose, name):
    path = public_tokenizers.path(name)
    df = spark.createDataFrame([(1, prose(50, 1)), (2, None), (3, " two  blanks ")], "doc_id int, text string")
    assert not splits_at_space(path)
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, path).collect()}
    assert got == {r.doc_id: len(encoder(path).ids([r.text or ""])[0]) for r in df.collect()}


def test_query_over_the_whole_table(spark, library):
    from conftest import SF_SMALL
    rows = op10_token_counts(spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = len(ids(library, texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 2048)


def test_frequent_words_are_counted_over_all_rows(spark):
    text = " ".join(w for w, n in (("a", 2), ("b", 40), ("c", 300), ("d", 41)) for _ in range(n))
    df = spark.createDataFrame([(text,), (text,), (None,)], "text string").repartition(2)
    assert set(frequent_words(df, table_size=1)) == {"c"}
    assert set(frequent_words(df, table_size=3)) == {"b", "c", "d"}
    assert set(frequent_words(df, table_size=10)) == {"a", "b", "c", "d"}
    assert len(frequent_words(df, table_size=2)) == 2 and frequent_words(df.limit(0)) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(min_size=1), min_size=1, max_size=6))
def test_word_by_word_is_exact(texts):
    library = Tokenizer.from_file(PATH)
    enc = encoder(PATH)
    for text in texts:
        text = text.encode("utf-8", "ignore").decode()
        buf, begin, end, _ = word_spans(pa.array([text], pa.large_string()))
        words = [buf[a:b].tobytes().decode() for a, b in zip(begin, end)]
        got = [int(x) for w in enc.words(words) for x in np.frombuffer(w, np.uint32)]
        assert got == library.encode(text, add_special_tokens=False).ids


def test_spans_and_hashes():
    texts = ["", "a  b\n", " c", "", "é x" * 300_000, "tail"]
    buf, begin, end, starts = word_spans(pa.array(texts, pa.large_string()))
    words = [buf[a:b].tobytes().decode() for a, b in zip(begin, end)]
    assert words == [w for t in texts for w in t.split()]
    assert np.diff(starts).tolist() == [len(t.split()) for t in texts]
    h = span_hashes(buf, begin, end)
    by_word = {}
    for w, x in zip(words, h.tolist()):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)
    assert hash_texts(["a", "tail"]).tolist() == [by_word["a"], by_word["tail"]]


def test_word_table_finds_exactly():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, 5000, dtype=np.uint64)
    t = WordTable(keys[:4000], [b"\0\0\0\0"] * 4000)
    assert (t.find(keys[:4000]) >= 0).all() and (t.find(keys[4000:]) == -1).all()
    assert (WordTable(keys[:0], []).find(keys) == -1).all()


def check_packing(rows, capacity):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq)


def test_packing_round_trip(spark, edge_docs, no_docs, library):
    packed = pack(edge_docs, PATH, with_ids=True)
    rows = packed.collect()
    check_packing(rows, 2048)
    want = []
    for r in edge_docs.collect():
        x = np.array(ids(library, r.text) + [0], "<u4")
        for k, s in enumerate(range(0, len(x), 2048)):
            p = x[s:s + 2048]
            want.append((r.doc_id is None, r.doc_id or 0, k, s, len(p), zlib.crc32(p.tobytes())))
    got = [(r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(want)
    flat = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in rows:
        assert flat[r.sequence_id][r.offset:r.offset + r.length] == r.ids
    assert pack(no_docs, PATH).count() == 0


def test_plan_fills_bins_and_uses_every_piece():
    for seed in range(30):
        rng = random.Random(seed)
        capacity = rng.choice([7, 30, 100])
        hist = {n: rng.randrange(1, 40) for n in rng.sample(range(1, capacity + 1), min(capacity, 6))}
        left = dict(hist)
        bins = 0
        for combo, times in plan_bins(hist, capacity):
            assert sum(n * k for n, k in combo.items()) <= capacity and times > 0
            bins += times
            for n, k in combo.items():
                left[n] -= k * times
        assert all(v == 0 for v in left.values())
        # first fit decreasing as a reference
        items = sorted((n for n, c in hist.items() for _ in range(c)), reverse=True)
        open_bins = []
        for n in items:
            for i, room in enumerate(open_bins):
                if room >= n:
                    open_bins[i] -= n
                    break
            else:
                open_bins.append(capacity - n)
        assert -(-sum(items) // capacity) <= bins <= len(open_bins) + 1


def test_each_bin_is_the_fullest_possible():
    hist = {6: 1, 5: 1, 3: 2, 2: 1}
    first, times = plan_bins(hist, 10)[0]
    assert first == {6: 1, 2: 1} or sum(n * k for n, k in first.items()) == 9  # 6+3 is the best for 10
    assert sum(n * k for n, k in first.items()) == 9 and times == 1


def test_sequence_count_is_near_the_bound(spark, library):
    from conftest import SF_MID
    from rowsift.llm.packing import op7_packing
    rows = op7_packing(spark, SF_MID).collect()
    bound = -(-sum(r.length for r in rows) // 2048)
    assert check_packing(rows, 2048) <= bound * 1.01 + 1
