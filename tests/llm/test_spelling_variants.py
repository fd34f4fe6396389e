"""Near words, forms and roots against plain loops; filters of several passes; odd texts."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rowsift.llm import spelling_variants as V


def plain_words(rows, min_length, min_count, thin):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % thin == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(n, ratio=5):
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=lambda r: r[0])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    alphabet = "abéÿ×"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.choice([1, 3, 5, 6, 7, 8]))) for _ in range(60)]
    words += ["a" * 6, "a" * 7, "b" + "a" * 6, "x" * 70, "x" * 71, "x" * 70 + "y", "É" * 40]
    rows = []
    for i in range(40):
        pick = [words[min(int(rng.expovariate(0.05)), len(words) - 1)] for _ in range(rng.randrange(60))]
        rows.append((None if i == 7 else i, rng.choice([" ", "1", "-\n", "你"]).join(pick)))
    rows += [(50, None), (51, ""), (52, "123 ++ \U0001f600"), (3, rows[3][1]), (53, "THE Therefore THEREFORE " * 90),
             (54, "therefor theefore tthereforee " * 9), (55, "xtherefore " * 500), (56, "xxtherefore xtheréfore " * 6)]
    return rows


@pytest.mark.parametrize("thin,filter_bytes", [(199, V.FILTER_BYTES), (3, 256)])
def test_variants_equal_plain_loops(spark, texts, thin, filter_bytes):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in V.variants(df, thin=thin, min_count=3, filter_bytes=filter_bytes).collect()]
    want = plain_variants(plain_words(texts, 6, 3, thin))
    assert sorted(got, key=lambda r: r[0]) == want
    assert len(want) > 20 and (thin == 3 or {"therefore", "xtherefore"} <= {r[0] for r in want})


def test_a_vocabulary_beyond_the_budget_takes_several_passes():
    shards = V.passes([(6, 900), (7, 40), (8, 3)], filter_bytes=1024)
    assert len(shards) > 2 and all(sum(s.lanes() for s in p) * 8 <= 1024 for p in shards)
    assert len([s for p in shards for s in p if s.length == 6]) == shards[0][0].parts > 1


def test_filters_pass_every_word_and_few_others(spark):
    words = [f"{'abcdefghij'[i % 10]}{i}".translate(str.maketrans("0123456789", "klmnopqrst")).ljust(8, "z") for i in range(5000)]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    (shards,) = V.passes([(8, len(words))])
    bits = V.filter_lanes(df, shards)
    for known, least, most in ((words, 5000, 5000), ([w[::-1] for w in words], 0, 60)):
        ((_, _, rows),) = list(V.by_length(pa.array(known)))
        h = V.mix(V.weights(rows).sum(axis=1) + np.uint64(8))
        assert least <= len(V.probe(h, shards[0], bits)) <= most


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, word string, n long")
    out = V.variants(df)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
    assert V.variants(spark.createDataFrame([(1, "abcdef " * 9)], "doc_id long, text string")).count() == 1
