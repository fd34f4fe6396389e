"""Near duplicates, decontamination and the pipeline against brute force."""

import collections
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from rowsift.llm import decontamination, near_dedup, toxicity
from rowsift.llm.near_dedup import components, deduplicate, near_duplicates, op9_near_dedup


def shingle_set(text, n=5):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_classes(texts, links):
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(len(texts))]


def test_near_duplicates_of_the_table(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").collect()
    sets = {d.doc_id: shingle_set(d.text) for d in docs}
    rows = op9_near_dedup(spark, SF_MID).collect()
    assert len(rows) == len(docs)
    cls = {r.doc_id: r.class_id for r in rows}
    where = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    shared = collections.Counter(p for ds in where.values() if len(ds) < 500 for p in itertools.combinations(ds, 2))
    links = 0
    for (a, b), n in shared.items():
        j = n / len(sets[a] | sets[b])
        if j >= 0.8:
            links += 1
            assert cls[a] == cls[b]
        if cls[a] == cls[b]:
            assert j > 0.1
    assert links > 50
    for c, members in itertools.groupby(sorted(rows, key=lambda r: r.class_id), key=lambda r: r.class_id):
        members = list(members)
        assert sum(r.keep for r in members) == 1 and {r.class_size for r in members} == {len(members)}
        assert c == min(r.doc_id for r in members)
        if len(members) > 1:  # every member has a close partner
            for m in members:
                assert any(o.doc_id != m.doc_id and len(sets[m.doc_id] & sets[o.doc_id]) >= 0.7 * len(
                    sets[m.doc_id] | sets[o.doc_id]) for o in members)


def test_chains_of_edits_become_one_class(spark):
    """A group whose members are linked only along chains, beside look-alikes."""
    rng = random.Random(5)
    text = [f"t{rng.randrange(10_000)}" for _ in range(150)]
    texts = [" ".join(text)]
    for _ in range(60):
        text = list(text)
        text[rng.randrange(len(text))] = f"e{rng.randrange(10_000)}"
        texts.append(" ".join(text))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"o{rng.randrange(10_000)}" for _ in range(100)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)
    rows = {r.doc_id: r for r in near_duplicates(df).collect()}
    assert len({rows[i].class_id for i in range(61)}) == 1 and rows[0].class_size == 61
    assert all(rows[i].class_size == 1 for i in range(61, 121))


def test_near_duplicates_edge_cases(spark, edge_docs, no_docs):
    rows = near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    size = {r.doc_id: r.class_size for r in rows if r.doc_id is not None}
    assert size[31] == 4 and size[30] == 4  # null and empty texts, one class
    assert size[33] == 3 and size[34] == 2 and size[35] == 2 and size[36] == 1 and size[32] == 1
    assert near_duplicates(no_docs).count() == 0
    kept = deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r.keep for r in rows) and deduplicate(no_docs).count() == 0


def test_sampling_estimates_weighted_similarity():
    rng = random.Random(2)
    base = [f"a{rng.randrange(5000)}" for _ in range(400)]
    idf = np.full(1 << near_dedup.DF_BITS, 8, np.uint8)
    for edits in (3, 15, 40):
        other = list(base)
        for _ in range(edits):
            other[rng.randrange(400)] = f"b{rng.randrange(5000)}"
        pair = [pa.array([" ".join(x)], pa.large_string()) for x in (base, other)]
        weighted, plain = near_dedup.similarities(*pair, idf)
        a, b = (shingle_set(" ".join(x)) for x in (base, other))
        assert abs(plain[0] - len(a & b) / len(a | b)) < 1e-9
        agree = []
        for p in pair:
            s, often, offsets = near_dedup.shingles(p)
            agree.append(near_dedup.signatures(s, near_dedup.levels(s, often, idf), offsets)[0])
        assert abs((agree[0] == agree[1]).mean() - weighted[0]) < 0.2


def test_components_and_frequencies(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    edges += [(300, i) for i in range(301, 340)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    at = {n: i for i, n in enumerate(nodes)}
    roots = brute_classes(nodes, [(at[a], at[b]) for a, b in edges])
    least = {}
    for n, r in zip(nodes, roots):
        least[r] = min(least.get(r, n), n)
    assert got == {n: least[r] for n, r in zip(nodes, roots)}
    docs = spark.createDataFrame([("a b c d e f",), ("a b c d e",), (None,)], "text string").repartition(3)
    cells, rows = near_dedup.document_frequencies(docs.fillna(""))
    assert rows == 3 and sorted(cells[cells > 0].tolist()) == [1, 2]


def test_document_frequencies_do_not_collide(spark):
    """With 2 M other shingles a unique shingle still weighs more than one of half the texts."""
    rng = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(30))
    texts = [" ".join(f"u{rng.getrandbits(60)}" for _ in range(10_000)) + (" " + shared if i % 2 else "") for i in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)
    rows = near_dedup.signed_rows(df.select("text", "id", F.col("id").cast("long").alias("row"), F.unhex(F.md5("text")).alias("key")))
    for r in rows.select("id", "levels").filter("id < 20").collect():
        s, _, _ = near_dedup.shingles(pa.array([texts[r.id]], pa.large_string()))
        common = set(near_dedup.shingles(pa.array([shared], pa.large_string()))[0].tolist()) & set(s.tolist())
        want = near_dedup.idf_levels(np.array([100 if x in common else 1 for x in s.tolist()]), 200)
        assert list(r.levels) == want.tolist() and len(set(want.tolist())) == 1 + r.id % 2


def test_plain_similarity_alone_makes_a_link(spark):
    """Texts equal but for how often one line repeats: plain above 0.8, weighted far below."""
    line = " ".join(f"l{i}" for i in range(20))
    texts = []
    for k in range(10):
        head = " ".join(f"h{k}x{i}" for i in range(30))
        texts += [head + " " + (line + f" e{k} ") * 2, head + " " + (line + f" e{k} ") * 100]
    idf = np.full(1 << near_dedup.DF_BITS, 8, np.uint8)
    weighted, plain = near_dedup.similarities(
        pa.array(texts[0::2], pa.large_string()), pa.array(texts[1::2], pa.large_string()), idf)
    assert plain.min() >= 0.8 and weighted.max() < 0.7
    rows = near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    cls = {r.doc_id: r.class_id for r in rows}
    assert all(cls[i] == cls[i + 1] == i for i in range(0, 20, 2))


def brute_leaks(docs, items):
    out = {}
    for d in docs:
        s = shingle_set(d.text)
        for i in items:
            q = shingle_set(i.text)
            if q and len(q & s) >= 0.8 * len(q) - 1e-9:
                out.setdefault((d.doc_id, i.item_id), len(q & s))
    return out


def test_decontamination_finds_exactly_the_contained_items(spark, prose, edge_docs, no_docs):
    rng = random.Random(8)
    items = [(i, prose(n, 1000 + i, 4000)) for i, n in enumerate([5, 6, 9, 17, 33, 34, 60, 120, 250])]
    items += [(50, None), (51, ""), (52, "one two"), (53, items[4][1]), (None, items[5][1])]
    docs = []
    for k in range(60):
        words = prose(rng.choice([50, 400, 3000]), k, 5000).split()
        if k % 2:
            passage = rng.choice(items[:9])[1].split()
            if k % 4 == 1 and len(passage) > 30:  # one word changed: five shingles lost
                passage[len(passage) // 2] = "changed"
            if k % 6 == 3:
                passage = passage[:len(passage) // 2]
            at = rng.randrange(len(words))
            words[at:at] = passage
        docs.append((k, " ".join(words)))
    docs += [(90, "one two"), (91, "one two three four five"), (92, None), (93, ""), (94, docs[1][1]), (94, docs[1][1])]
    d = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id int, text string, key string")
    b = spark.createDataFrame([(a, b, "y") for a, b in items], "item_id int, text string, h string")
    got = collections.Counter((r.doc_id, r.item_id, r.n_found) for r in decontamination.find_leaks(d, b).collect())
    want = collections.Counter()
    for x in d.collect():
        for (_, i), n in brute_leaks([x], b.collect()).items():
            want[(x.doc_id, i, n)] += 1
    assert got == want and len(got) > 20
    clean = decontamination.decontaminate(d, b)
    leaking = {k for k, _, _ in want}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(k for k, _ in docs if k not in leaking)
    assert clean.columns == d.columns
    assert decontamination.find_leaks(no_docs, b).count() == 0
    assert decontamination.decontaminate(edge_docs, b.limit(0)).count() == edge_docs.count()


def test_decontamination_runs_no_python(spark):
    from conftest import SF_SMALL
    plan = decontamination.op5_decontamination(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


@pytest.fixture(scope="module")
def staged(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = [("start", docs.cache())]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stage(spark, out[-1][1], SF_MID).cache()))
    return SF_MID, dict(out)


def test_pipeline_stages_against_brute_force(spark, staged):
    sf, at = staged
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {n: collections.Counter(r[0] for r in df.select("doc_id").collect()) for n, df in at.items()}
    names = ["start", *(n for n, _ in corpus_pipeline.STAGES)]
    for before, after in zip(names, names[1:]):
        assert not ids[after].keys() - ids[before].keys()
        if after != "packing":
            assert at[after].columns == at["start"].columns
    gone = ids["start"].keys() - ids["toxicity"].keys()
    known = [labels[d].toxic for d in gone if d in labels]
    assert sum(known) >= 0.95 * len(known)
    assert len([d for d in labels if labels[d].toxic and d in ids["toxicity"]]) <= 0.5 * sum(r.toxic for r in labels.values())
    gone = ids["toxicity"].keys() - ids["quality"].keys()
    assert all(labels[d].quality == 0 for d in gone if d in labels)
    texts = {r.doc_id: shingle_set(r.text) for r in at["near_dedup"].collect()}
    where = collections.defaultdict(list)
    for d, s in texts.items():
        for x in s:
            where[x].append(d)
    shared = collections.Counter(p for ds in where.values() for p in itertools.combinations(ds, 2))
    assert not [p for p, n in shared.items() if n >= 0.8 * len(texts[p[0]] | texts[p[1]])]
    leaks = brute_leaks(at["near_dedup"].collect(), spark.read.parquet(f"{sf}/benchmark.parquet").collect())
    assert ids["near_dedup"].keys() - ids["decontamination"].keys() == {d for d, _ in leaks}
    assert ids["packing"].keys() == ids["decontamination"].keys()


def test_pipeline_on_an_empty_table(spark, no_docs, tmp_path):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0
        if "text" not in docs.columns:
            break


def test_planted_toxic_words_are_caught(spark):
    from conftest import SF_MID
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"), F.lit(True))
    clean = "The weather was mild and the ands of it to the she on that re. " * 3
    planted = spark.createDataFrame(
        [(i, clean + f"You are a {w} and a pathetic {v}, stupid trash.") for i, (w, v) in enumerate(
            itertools.permutations(("idiot", "moron", "loser", "clown"), 2))] + [(100, clean)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(planted, *model).collect()}
    assert score.pop(100) < 0.5 and all(s >= 0.5 for s in score.values())
