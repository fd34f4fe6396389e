"""Quality, toxicity and language-model scores: held-out accuracy and brute force."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F
from rowsift.llm import lm_scoring, quality_classifier, toxicity
from rowsift.llm.common import fold, hash_texts
from rowsift.llm.linear import DIM, ftrl, logistic, margins, sparse_rows


def auc(labels, scores):
    order = np.argsort(np.argsort(scores, kind="stable")) + 1
    y = np.asarray(labels) == 1
    return (order[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


@pytest.mark.parametrize("name,label,least", [("op1", "quality", 0.98), ("op4", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    query = quality_classifier.op1_quality if name == "op1" else toxicity.op4_toxicity
    out = query(spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert auc([r[label] for r in held], [r.score for r in held]) > least
    wrong = [r for r in held if r.predicted != r[label]]
    assert len(wrong) < 0.03 * len(held)


@pytest.mark.parametrize("module,label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_edge_cases_of_classifiers(spark, edge_docs, no_docs, edge_labels, module, label):
    def train(docs, labels):
        if module is toxicity:
            return toxicity.train(docs, labels, fold("doc_id") != 0)
        return quality_classifier.train(docs, labels.filter(fold("doc_id") != 0))

    model = train(edge_docs, edge_labels)
    rows = module.score(edge_docs, *model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (30, 31, 32)}
    assert len(empty) == 1 and empty == {float(logistic(np.array([model[1]]))[0])}
    assert module.score(no_docs, *model).count() == 0
    untrained = train(no_docs, edge_labels.limit(0))
    flat = {round(r.score, 6) for r in module.score(edge_docs, *untrained).collect()}
    assert flat == ({0.5} if module is quality_classifier else {0.05})
    keep = module.keep_good if module is quality_classifier else module.keep_clean
    kept = keep(edge_docs, *model)
    assert kept.columns == edge_docs.columns and keep(no_docs, *model).count() == 0


def test_sparse_scores_are_dot_products(prose):
    texts = pa.array([prose(40, 1), "", prose(7, 2) + " !!! | a a a"], pa.large_string())
    rng = np.random.default_rng(0)
    w = rng.normal(size=DIM).astype(np.float32)
    families = quality_classifier.quality_features(texts)
    for presence in (False, True):
        dense = [0.5 + sum(w[i] * x for i, x in zip(*row)) for row in sparse_rows(families, presence)]
        assert np.allclose(margins(families, w, 0.5, presence), dense, atol=1e-3)


def test_ftrl_learns_and_l1_zeroes():
    rng = np.random.default_rng(1)
    rows = [(np.array([1, 2] if y else [1, 3]), np.ones(2)) for y in rng.integers(0, 2, 400)]
    labels = np.array([1.0 if 2 in r[0] else 0.0 for r in rows])
    w, b = ftrl(rows, labels, 3, 0.5, 1.0, 0.01, 0.0)
    assert w[2] > 1 and w[3] < -1 and abs(w[1]) < w[2]
    assert not ftrl(rows, labels, 1, 0.5, 1.0, 1e6, 0.0)[0].any()


def test_label_model_recovers_accuracies(spark):
    rng = np.random.default_rng(3)
    y = rng.random(6000) < 0.2
    votes = np.stack([rng.random(6000) < np.where(y, a, b) for a, b in ((.8, .02), (.7, .05), (.6, .01), (.5, .03))], 1)
    votes = np.concatenate((votes, votes[:, :1]), axis=1)  # a copy of the first voter
    counts = collections.Counter(tuple(x) for x in toxicity.lanes(votes).tolist())
    df = spark.createDataFrame([(-1.0, list(v), n) for v, n in counts.items()], "known double, v array<long>, n long")
    model = toxicity.fit_label_model(df, 5, steps=25)
    assert abs(model.prior - 0.2) < 0.04
    assert np.allclose(model.rates[1], [.8, .7, .6, .5, .8], atol=0.25)
    assert model.discount[0] < 0.7 and model.discount[4] < 0.7 and model.discount[2] > 0.9
    assert auc(y, model.posterior(votes.astype(float))) > 0.95
    for wide in (votes, rng.random((50, 62)) < 0.5, rng.random((50, 200)) < 0.5):
        assert (toxicity.votes_in(toxicity.lane_column(toxicity.lanes(wide)), wide.shape[1]) == wide).all()


def test_silent_voters_of_another_language_do_not_acquit(spark):
    """Ten common voters in one language, 150 rare ones in the other; three rows in ten have a label."""
    rng = np.random.default_rng(5)
    n = 6000
    y, one, labelled = rng.random(n) < 0.1, rng.random(n) < 0.6, rng.random(n) < 0.3
    common = rng.random((n, 10)) < np.where(y & one, 0.5, 0)[:, None]
    rare = rng.random((n, 150)) < np.where(y & ~one, 0.1, 0)[:, None]
    votes = np.concatenate((common, rare), axis=1)
    known = np.where(labelled, y, -1).astype(float).tolist()
    counts = collections.Counter((k, *x) for k, x in zip(known, toxicity.lanes(votes).tolist()))
    df = spark.createDataFrame([(k, list(v), c) for (k, *v), c in counts.items()], "known double, v array<long>, n long")
    q = toxicity.fit_label_model(df, 160).posterior(votes.astype(float))
    assert all((q[y & mine] > 0.5).mean() > 0.95 for mine in (one, ~one)) and q[~y].max() < 0.01


def test_nested_beginnings_give_way_to_the_one_with_most_evidence():
    v = toxicity.Voters(["zorg", "idiot"], ["blark", "blarkx", "bla", "quin", "idio", "quinto"])
    assert v.prefixes == ["blark", "quin"] and ("zorg",) in v.lists and v.lists.count(("idiot",)) == 1
    many = toxicity.Voters([f"w{i}" for i in range(500)], [f"{chr(97 + i % 26)}{i:03d}" for i in range(500)])
    assert many.count == len(toxicity.SEED_WORDS) + 3 + toxicity.MINED_WORDS + toxicity.MINED_PREFIXES + 4 > 124


def test_votes_equal_a_plain_version():
    v = toxicity.Voters(["zorg", "blah"], ["qui", "mop"])
    texts = ["Zorg! you QUINTO, quix mopping", "blah", "", "idiot (stupid) zorg", "quia quib quic quid " + "x " * 900, "ordure cretin mop"]
    got = v.votes(pa.array(texts, pa.large_string()))
    for t, row in zip(texts, got):
        words = [re.sub(r"^[\W_]+|[\W_]+$", "", w.lower()) for w in t.split()]
        kinds = [any(w in ws for w in words) for ws in v.lists]
        heads = [any(w.startswith(p) for w in words) for p in v.prefixes]
        lexical = sum(any(w in ws for ws in v.lists) for w in words)
        shaped = sum(any(w.startswith(p) for p in v.prefixes) for w in words)
        several = [sum(kinds) >= 2, sum(kinds) >= 2 and 100 * lexical >= len(words), shaped >= 2 and 100 * shaped >= len(words), shaped >= 4]
        assert row.tolist() == kinds + heads + several


def test_a_quarter_of_the_labels_still_finds_most_toxic_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    few = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4)) == 0)
    model = toxicity.train(docs, few, fold("doc_id") != 0)
    rows = toxicity.score(docs.filter(fold("doc_id") == 0), *model).join(labels, "doc_id").collect()
    y, q = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    assert (q[y == 1] > np.quantile(q[y == 0], 0.9)).mean() > 0.8 and (q[y == 0] >= 0.5).mean() < 0.01


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def check_base(rows, docs):
    seen = collections.Counter()
    for d in docs:
        if zlib.crc32(("" if d.doc_id is None else str(d.doc_id)).encode()) % 5 != 1:
            seen.update(tokens(d.text))
    n, v = sum(seen.values()), len(seen)
    want = []
    for d in docs:
        t = tokens(d.text)
        want.append((d.doc_id is None, d.doc_id or 0, len(t), sum(x in seen for x in t),
                     sum(math.log10((seen[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t)))
    got = [(r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, r.base_score) for r in rows]
    for a, b in zip(sorted(got), sorted(want)):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) < 1e-6 * max(1, abs(b[4]))
    assert {r.train_tokens for r in rows} <= {n}


def test_language_model_base_scores(spark, edge_docs, no_docs):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = lm_scoring.op2_lm_scoring(spark, SF_SMALL).collect()
    check_base(rows, docs.collect())
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # contexts help on unseen texts
    edge = lm_scoring.lm_scores(edge_docs, fold("doc_id") != 1)
    check_base(edge.collect(), edge_docs.collect())
    assert lm_scoring.lm_scores(no_docs, fold("doc_id") != 1).count() == 0


def test_tree_scores_match_brute_force(spark):
    """Counts, retention, smoothing and scores rebuilt with dictionaries."""
    texts = ["the cat sat on the mat", "the cat sat on the hat", "a dog sat", "the cat ran", "a dog sat on the cat"] * 4
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    depth, d = 2, 0.5
    tree, _ = lm_scoring.learn(df, depth=depth, share=0.0, discount=d)
    grams = collections.Counter()
    for t in texts:
        s = [None] + tokens(t)
        for i in range(1, len(s)):
            for n in range(1, depth + 2):
                if i - n + 1 >= 0:
                    grams[tuple(s[i - n + 1:i + 1])] += 1
    ones = {g[0]: c for g, c in grams.items() if len(g) == 1}
    n, v = sum(ones.values()), len(ones)
    base = {w: (c + 0.5) / (n + 0.5 * (v + 1)) for w, c in ones.items()}
    retained = {}
    prob = {(): base}

    def p(context, w):
        if not context:
            return base[w]
        if context not in retained:
            return p(context[1:], w)
        own, left = retained[context]
        return own.get(w, 0) + left * p(context[1:], w)

    for size in range(1, depth + 1):
        contexts = collections.defaultdict(dict)
        for g, c in grams.items():
            if len(g) == size + 1 and c >= 2:
                contexts[g[:-1]][g[-1]] = c
        new = {}
        for s, nexts in contexts.items():
            total = grams[s]
            own = {w: (c - d) / total for w, c in nexts.items()}
            left = 1 - sum(own.values())
            q = {w: p(s[1:], w) for w in nexts}
            r = {w: own[w] + left * q[w] for w in nexts}
            rest_r, rest_q = max(1 - sum(r.values()), 1e-12), max(1 - sum(q.values()), 1e-12)
            kl = sum(r[w] * math.log(r[w] / q[w]) for w in nexts) + rest_r * math.log(rest_r / rest_q)
            if total * kl > 0.5 * math.log(total + 1) * len(nexts):
                new[s] = (own, left)
        retained |= new
    assert len(tree.contexts) == len(retained) > 0
    assert len(tree.entries) == sum(len(own) for own, _ in retained.values())
    out = lm_scoring.lm_scores(df, F.lit(True), depth=depth, share=0.0, discount=d)
    for r in out.collect():
        s = [None] + tokens(texts[r.doc_id])
        want = sum(math.log10(p(tuple(s[max(0, i - depth):i]), s[i])) for i in range(1, len(s)))
        assert abs(r.score - want) < 1e-9


def test_next_symbol_distributions_sum_to_one(spark):
    texts = ["x y z", "x y w", "x y z x y z", "q y w"] * 5
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    tree, _ = lm_scoring.learn(df, depth=2, share=0.0)
    words = tree.words
    for context in (["x"], ["y"], ["x", "y"], ["q", "y"]):
        h = np.concatenate([np.concatenate((hash_texts(context), [w])) for w in words])
        bounds = np.arange(0, len(h) + 1, len(context) + 1)
        word, base, p = lm_scoring.token_scores(h, bounds, tree, 2)
        total = p[bounds[1:] - 1].sum()
        assert 1 - 0.5 / tree.denominator - 1e-9 <= total <= 1 + 1e-9  # the rest is the unknown word's


def test_rare_ngrams_count_at_every_corpus_size(spark):
    """Padding far above 2 / 2e-6 tokens must not push a repeated passage out of the tree."""
    passage = "alpha beta gamma delta epsilon zeta"
    padding = " ".join(["pad"] * 50_000)
    texts = [passage, passage, passage] + [padding] * 40
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    rows = {r.doc_id: r for r in lm_scoring.lm_scores(df, F.col("doc_id") != 2).collect()}
    assert rows[2].train_tokens * 2e-6 > 3 and rows[2].n_tokens == 7
    # the passage's contexts were seen twice: its words cost less than half of what they do without
    assert rows[2].score > rows[2].base_score / 2
