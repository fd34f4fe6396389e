"""Product codes against a plain version, the search against all distances, odd vectors."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from rowsift.llm import vector_codes as V


@pytest.mark.parametrize("kind", ["spread", "ties", "far sums", "large"])
def test_search_finds_the_first_nearest_entry(kind):
    rng = np.random.default_rng(len(kind))
    high = {"ties": 2, "large": 1 << 26}.get(kind, 600)
    x, book = rng.integers(-high, high, (700, 8)), rng.integers(-high, high, (90, 8))
    if kind == "far sums":
        book += rng.integers(-40, 40, (90, 1)) * 300
        x += rng.integers(-40, 40, (700, 1)) * 300
    index, dist, taken = V.nearest(x, book, run=64)
    every = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all() and (dist == every.min(axis=1)).all()
    assert taken <= every.size and (kind != "far sums" or taken < every.size / 2)


def test_distances_beyond_64_bits_are_refused():
    with pytest.raises(OverflowError):
        V.nearest(np.full((1, 8), 1 << 30), np.zeros((1, 8), np.int64))


def plain(rows, parts, entries, rounds):
    """The contract, one vector at a time."""
    kept = [(i, [math.floor(1024 * c) for c in v], lab) for i, v, lab in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    first = {}
    for (i, _, _), c in sorted(zip(kept, cut), key=lambda t: (t[0][0] is None, t[0][0] or 0, t[1])):
        if i is not None and len(first) < entries:
            first.setdefault(i, c)
    books = [[c[p] for c in first.values()] for p in range(parts)]

    def near(p, c):
        return min((sum((a - b) ** 2 for a, b in zip(c, e)), j) for j, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(p, c[p])[1]].append(c[p])
            for j, g in groups.items():
                books[p][j] = [sum(col) // len(g) for col in zip(*g)]
    label, out = defaultdict(int), []
    for (i, _, lab), c in zip(kept, cut):
        found = [near(p, c[p]) for p in range(parts)]
        label[lab] += sum(d for d, _ in found)
        out.append((i, lab, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found)))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, c, e, label[lab]) for i, lab, c, e in out), key=repr), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("entries", [3, 12, 256])
def test_codes_equal_a_plain_version(spark, entries):
    rng = np.random.default_rng(entries)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.01 if i % 3 else 1, 8)], None if i % 5 == 0 else int(i % 4))
            for i in rng.permutation(90)]
    rows += rows[:6] + [(200, None, 1), (201, [1.0] * 7 + [None], 1), (202, [float("nan")] * 8, 1), (203, [float("inf")] * 8, 2),
                        (None, rows[0][1], 1), (5, [9.0] * 8, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    rows = [tuple(r) for r in df.collect()]
    coded, books = V.compress(df, entries=entries)
    got = sorted(((r.id, r.code, r.error, r.label_error) for r in V.with_label_error(coded).collect()), key=repr)
    want, sha = plain(rows, 4, entries, 4)
    assert got == want and V.digest(books) == sha


def test_one_heavy_label_and_many_light_ones(spark):
    df = spark.range(6000).selectExpr("id", "if(id < 3000, null, id) label", "'00' code", "id error")
    got = {r.id: r.label_error for r in V.with_label_error(df).collect()}
    assert len(got) == 6000 and {got[i] for i in range(3000)} == {sum(range(3000))}
    assert all(got[i] == i for i in range(3000, 6000))


def test_odd_tables(spark):
    kind = "vec_id long, embedding array<double>, label int"
    coded, books = V.compress(spark.createDataFrame([], kind))
    assert books is None and coded.count() == 0
    coded, books = V.compress(spark.createDataFrame([(1, None, 0), (2, [None] * 4, 0)], kind))
    assert books is None and coded.count() == 0
    coded, _ = V.compress(spark.createDataFrame([(1, [], 0), (2, [], 1)], kind))
    assert [(r.code, r.error) for r in coded.collect()] == [("00000000", 0)] * 2
    coded, _ = V.compress(spark.createDataFrame([(1, [1.0] * 4, 0), (2, [1.0] * 8, 0), (None, [1.0] * 4, 0)], kind))
    assert sorted((r.id or 0, r.code, r.error) for r in coded.collect()) == [(0, "00000000", 0), (1, "00000000", 0), (2, None, None)]
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1.0] * 6, 0)], kind))
