"""Benchmark decontamination: short test items inside long documents.

Shingles are five lower-cased words in a row (a text of one to four words is one
shingle). Search: size-partitioned MinHash containment. Items are partitioned by
the power of two of their number of shingles; an item's sketch is the ``k`` smallest
hashes of its shingles, with ``k`` set per partition to one more than the shingles that may be
missing there plus a margin. A document that holds ``similarity`` of an item's
shingles lacks at most ``m - ceil(similarity * m)`` of them, so it holds at least
the rest of the sketch: candidates need that many sketch hits and no
contaminated document is lost, however long it is. Document shingles above the largest
sketch value are dropped before they become rows, the others meet the sketches in an
equi-join. Verification: exact containment of the shingles themselves (texts, not
hashes) over the whole candidate documents.

Contamination is a function of the text, so documents are handled by the md5 of
their text; copies are one candidate. Only DataFrame functions are used. Sketches, item
shingles and candidate keys are broadcast if their counted size fits
``broadcast_bytes`` and joined by shuffle otherwise.

Defined cases: null or empty texts and items never match; items with equal
texts share one search and are all reported; null ids are reported as null; repeated
rows are reported one by one; other columns are ignored (``decontaminate`` passes them
on); empty tables give an empty result (nothing is contaminated).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, stored, table

WORDS = 5
SIMILARITY = 0.8
MARGIN = 4
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def as_row(words: Column) -> Column:
    """The word array as a generated row, so that it is split once and not again
    wherever a later expression mentions it."""
    return F.explode(F.array(words)).alias("w")


def shingle_hashes(words: str) -> Column:
    """Array of 64-bit shingle hashes of the word array column ``words``."""
    parts = ", ".join(f"{words}[i + {k}]" for k in range(WORDS))
    return F.expr(f"""CASE WHEN size({words}) >= {WORDS}
        THEN transform(sequence(0, size({words}) - {WORDS}), i -> xxhash64({parts}))
        WHEN size({words}) > 0 THEN array(xxhash64(array_join({words}, ' ')))
        ELSE cast(array() AS array<bigint>) END""")


def shingle_texts(words: str) -> Column:
    return F.expr(f"""CASE WHEN size({words}) >= {WORDS}
        THEN transform(sequence(1, size({words}) - {WORDS - 1}), i -> array_join(slice({words}, i, {WORDS}), ' '))
        WHEN size({words}) > 0 THEN array(array_join({words}, ' '))
        ELSE cast(array() AS array<string>) END""")


def text_key(column: str) -> Column:
    return F.unhex(F.md5(F.coalesce(quoted(column), F.lit(""))))


def small(df: DataFrame, bytes_per_row: int, limit: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within ``limit``."""
    return F.broadcast(df) if df.count() * bytes_per_row <= limit else df


def sketches(items: DataFrame, similarity: float, margin: int) -> DataFrame:
    """(item, h, need): sketch hashes of each item and how many a document must hold."""
    allowed = F.col("m") - F.ceil(F.col("m") * similarity - 1e-9)
    largest = F.pow(F.lit(2), F.floor(F.log2("m")) + 1) - 1
    k = (F.floor(largest * (1 - similarity)) + margin).cast("int")
    sized = (items.select("item", F.sort_array(F.array_distinct(shingle_hashes("w"))).alias("hashes"))
             .withColumn("m", F.size("hashes")).filter("m > 0")
             .withColumn("k", F.least(F.col("m"), F.greatest(k, (allowed + 1).cast("int")))))
    return (sized.withColumn("need", (F.col("k") - allowed).cast("int"))
            .select("item", "need", F.explode(F.slice("hashes", F.lit(1), F.col("k"))).alias("h")))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                       item_text_col: str = "text", similarity: float = SIMILARITY, margin: int = MARGIN,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(key, item, n_item, n_found): text keys and item keys with enough containment."""
    items = (benchmark.select(text_key(item_text_col).alias("item"), quoted(item_text_col).alias("text"))
             .filter("text is not null").dropDuplicates(["item"])
             .select("item", as_row(words_of(F.col("text")))).filter("size(w) > 0"))
    sketch = stored(sketches(items, similarity, margin), "item-sketches")
    top = sketch.agg(F.max("h")).first()[0]
    texts = docs.select(text_key(text_col).alias("key"), quoted(text_col).alias("text")).filter("text is not null")
    hashes = (texts.select("key", as_row(words_of(F.col("text"))))
              .select("key", F.filter(shingle_hashes("w"), lambda h: h <= F.lit(top)).alias("hs"))
              .select("key", F.explode_outer("hs").alias("h")).filter("h is not null"))
    candidates = stored(
        hashes.join(small(sketch, 40, broadcast_bytes), "h")
        .groupBy("key", "item", "need", "h").agg(F.lit(1).alias("one"))
        .groupBy("key", "item", "need").agg(F.count("*").alias("hits"))
        .filter("hits >= need").select("key", "item"), "candidates")
    wanted = candidates.select("key").distinct()
    whole = (texts.join(small(wanted, 40, broadcast_bytes), "key").groupBy("key").agg(F.first("text").alias("text")))
    held = (whole.select("key", as_row(words_of(F.col("text"))))
            .select("key", F.explode(F.array_distinct(shingle_texts("w"))).alias("shingle")))
    owned = items.select("item", F.explode(F.array_distinct(shingle_texts("w"))).alias("shingle"))
    sizes = owned.groupBy("item").agg(F.count("*").alias("n_item"))
    found = (held.join(small(owned, 120, broadcast_bytes), "shingle").join(candidates, ["key", "item"])
             .groupBy("key", "item").agg(F.count("*").alias("n_found")))
    return (found.join(sizes, "item").filter(F.col("n_found") >= F.col("n_item") * similarity - 1e-9)
            .select("key", "item", "n_item", "n_found"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               item_text_col: str = "text", item_id_col: str = "item_id", similarity: float = SIMILARITY
               ) -> DataFrame:
    """(doc id, item id, n_item, n_found, containment) for every contaminated pair."""
    pairs = stored(contaminated_texts(docs, benchmark, text_col, item_text_col, similarity), "leaks")
    ids = docs.select(quoted(id_col).alias("d"), text_key(text_col).alias("key"))
    items = benchmark.select(quoted(item_id_col).alias("i"), text_key(item_text_col).alias("item"))
    return (ids.join(small(pairs, 60, BROADCAST_BYTES), "key").join(small(items, 60, BROADCAST_BYTES), "item")
            .select(F.col("d").alias(id_col), F.col("i").alias(item_id_col), "n_item", "n_found",
                    (F.col("n_found") / F.col("n_item")).alias("containment")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without the rows whose text holds an item; all columns stay."""
    pairs = contaminated_texts(docs, benchmark, text_col, item_text_col, similarity)
    name = "leaking_key"
    while name in docs.columns:
        name += "_"
    bad = stored(pairs.select(F.col("key").alias(name)).distinct(), "leaking-texts")
    kept = docs.withColumn(name, text_key(text_col)).join(small(bad, 40, BROADCAST_BYTES), name, "left_anti")
    return kept.select(*(quoted(c) for c in docs.columns))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _shingled(source: str, key: str) -> str:
    words = "[x FOR x IN regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+') IF x <> '']"
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5
      THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM (SELECT {key}, {words} AS w FROM {source})"""


SQL = f"""
WITH d AS ({_shingled('documents', 'doc_id')}), b AS ({_shingled('benchmark', 'item_id')}),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY 1),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN b USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM f JOIN n USING (item_id) WHERE n_found >= n_item * 0.8 - 1e-9
"""

QUERIES = {"op5_decontamination": op5_decontamination}
ORACLES = {"op5_decontamination": SQL}
