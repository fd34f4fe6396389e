"""Sharding, quality rules and URL filter against brute force and SQL."""

import collections
import random
import re
import zlib

import pytest

from rowsift.llm.quality_rules import clean_lines, op8_quality_rules
from rowsift.llm.sharding import Range, assign_shards, cut_keys, op3_sharding, write_shards
from rowsift.llm.url_filter import RULES, canonical, filter_urls, possible_hits
from pyspark.sql import functions as F


def smallest_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, fill = (low + high) // 2, 1, 0
        for x in sizes:
            if fill + x > mid:
                used, fill = used + 1, 0
            fill += x
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def test_capacity_is_minimal():
    for seed in range(60):
        rng = random.Random(seed)
        items = sorted((rng.getrandbits(60), rng.choice([1, 5, 100, rng.randint(1, 1000)]))
                       for _ in range(rng.choice([1, 3, 20, 300, 2000])))

        def ranges(rows, shift):
            by = collections.OrderedDict()
            for k, s in rows:
                by.setdefault(k >> shift, []).append((k, s))
            return [Range(p, shift, sum(s for _, s in v), len({k for k, _ in v}) == 1, v[-1][0]) for p, v in by.items()]

        def refine(wide):
            return [x for r in wide for x in ranges([i for i in items if i[0] >> r.shift == r.prefix],
                                                    max(0, r.shift - 2))]

        cuts, capacity = cut_keys(ranges(items, 57), 8, refine)
        assert capacity == smallest_capacity([s for _, s in items], 8)
        assert cuts == sorted(cuts)
        filled = collections.Counter(sum(k > c for c in cuts) for k, _ in items)
        size = collections.Counter()
        for k, s in items:
            size[sum(k > c for c in cuts)] += s
        assert max(size.values()) <= capacity and len(filled) <= 8


def check_shards(rows, docs, shards):
    assert len(rows) == len(docs)
    by_text, slots = {}, collections.defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        by_text.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs)
    assert sorted((r.size, r.text_crc32) for r in rows) == want


def test_sharding_edge_cases(spark, edge_docs, no_docs, tmp_path):
    check_shards(assign_shards(edge_docs, 4).collect(), edge_docs.collect(), 4)
    assert assign_shards(no_docs, 4).count() == 0
    write_shards(edge_docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == edge_docs.count()


def test_sharding_query_and_hot_text(spark):
    from conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = op3_sharding(spark, SF_SMALL).collect()
    check_shards(rows, docs.collect(), 16)
    hot = docs.select("doc_id", "text").union(
        spark.range(400).select(F.col("id") + 10_000, F.lit("hot text " * 400)))
    out = assign_shards(hot, 8).groupBy("shard").agg(F.sum("size").alias("n"), F.countDistinct("text_crc32").alias("t")).collect()
    alone = [r for r in out if r.t == 1 and r.n >= 400 * 3600]
    rest = [r.n for r in out if r not in alone]
    assert len(alone) == 1 and len(rest) == 7 and max(rest) < 1.6 * sum(rest) / 7


def base_figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", " ".join(words))), dup, len(hit))


@pytest.mark.parametrize("source", ["edge", "table"])
def test_quality_figures(spark, edge_docs, source):
    from conftest import SF_SMALL
    docs = edge_docs if source == "edge" else spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = clean_lines(docs).collect() if source == "edge" else op8_quality_rules(spark, SF_SMALL).collect()
    want = sorted((d.doc_id is None, d.doc_id or 0, *base_figures(d.text)) for d in docs.collect())
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                 for r in out)
    assert got == want
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_line_rules(spark, prose, no_docs):
    good = "\n".join(prose(30, i) for i in range(4))
    notes = "".join(f"{i}a {i}b {i}c {i}d {i}e all rights reserved.\n" for i in range(12))
    cases = {
        1: (good, True), 2: (good + "\nHome | About | Contact | Login", True),
        3: ("\n".join(prose(30, i).replace(" ", " | ") for i in range(4)), False),
        4: (" ".join(w + "$$$" for w in good.split()), False),
        5: (" ".join(w.upper() + "!!" for w in good.split()), False),
        6: (good + "\nLicensed under the Apache License, Version 2.0.", True),
        7: (" ".join(w for w in good.split() for _ in range(2)), False),
        8: ("no sentence ends here " * 20, False), 9: (None, False), 10: ("", False),
        11: (notes + "Alone.", False), 12: (notes + " ".join(good.split()[:11]) + ".", True),
    }
    df = spark.createDataFrame([(k, t) for k, (t, _) in cases.items()], "doc_id int, text string")
    got = {r.doc_id: r for r in clean_lines(df).collect()}
    assert {k: r.kept for k, r in got.items()} == {k: v for k, (_, v) in cases.items()}
    assert got[2].clean_text == good and got[6].clean_text == good and got[9].clean_text == ""
    assert clean_lines(no_docs).count() == 0


def test_quality_rules_keep_clean_documents(spark):
    from conftest import SF_MID
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    out = op8_quality_rules(spark, SF_MID).join(labels, "doc_id").filter("not base_failed")
    n = {(r.quality, r.kept): r.n for r in out.groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert n.get((1, False), 0) <= 0.02 * n[(1, True)] and n.get((0, True), 0) <= 0.1 * max(n.get((0, False), 0), 1)


def test_url_filter_edge_cases(spark):
    urls = [(1, "http://a.net/x"), (2, "http://example.net/en/1"), (3, "http://WWW.Example.NET:80/en"),
            (4, "no scheme"), (5, None), (None, "https://x.example.com/de/"), (7, "http://b.org/fr/q?x=http://a.net/"),
            (8, "ftp://bad.example.com/a/?utm_source=x&b=1#top"), (9, "http://bad.example.com/a?b=1"), (9, "http://bad.example.com/a?b=1"),
            (10, "http://"), (11, "http://notnet/"), (12, "http://net"), (13, "")]
    pages = spark.createDataFrame([(i, u, "x", "y", "z") for i, u in urls], "page_id int, url string, host string, canon string, listed string")
    listed = spark.createDataFrame([("https://www.bad.example.com/a/index.html?b=1",), (None,), ("junk",), ("http://bad.example.com/a?b=1",)], "url string")
    rows = filter_urls(pages, listed, RULES).collect()
    assert len(rows) == len(urls)
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict, r.listed) for r in rows}
    assert got[1, "a.net", "/x"] == ("net/", "block", False)
    assert got[2, "example.net", "/en/1"][:2] == ("example.net/en/", "allow")
    assert got[3, "www.example.net:80", "/en"][:2] == (None, "allow")
    assert got[4, "", ""] == (None, "allow", False) and got[5, "", ""] == (None, "allow", False)
    assert got[None, "x.example.com", "/de/"][:2] == ("example.com/de/", "block")
    assert got[7, "b.org", "/fr/q"][:2] == ("org/fr/", "allow")
    assert got[8, "bad.example.com", "/a/"] == (None, "block", True) == got[9, "bad.example.com", "/a"]
    assert got[11, "notnet", "/"][:2] == (None, "allow") and got[12, "net", ""][:2] == (None, "allow")
    assert filter_urls(pages.limit(0), listed, RULES).count() == 0
    none = filter_urls(pages, listed.limit(0), RULES).collect()
    assert len(none) == len(urls) and not any(r.listed for r in none)
    shuffled = filter_urls(pages, listed, RULES, broadcast_bytes=0).collect()
    assert sorted(map(str, shuffled)) == sorted(map(str, rows))


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h"), "id").alias("canon"))
    urls = spark.range(20_000).select(F.concat(F.lit("h"), "id").alias("canon"), "id")
    out = possible_hits(urls, listed).groupBy((F.col("id") < 5000).alias("real"), "maybe").count().collect()
    n = {(r.real, r.maybe): r["count"] for r in out}
    assert (True, False) not in n and n[True, True] == 5000 and n.get((False, True), 0) < 300


def test_canonical_forms(spark):
    df = spark.createDataFrame([("HTTP://WWW.A.com:443/x/index.html?utm_a=1&q=2&ref=3#f",), ("http://a.com./x/?q=2",)], "u string")
    assert {r[0] for r in df.select(canonical(F.col("u"))).collect()} == {"a.com/x?q=2"}
