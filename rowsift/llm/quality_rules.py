"""Quality rules, line first: judge every line, remove the failing ones, then
reject documents that lost too much of their text.

A line (split at ``\\n``) with at least one word fails if any rule holds:

* ``punctuation``: no word of it ends a sentence;
* ``navigation``: separator words (``|`` and the like) make up a quarter of it,
  or it is a chain of menu words;
* ``boilerplate``: it holds a notice such as a licence or cookie line;
* ``symbols``: a third of its words hold a run of symbols;
* ``shouting``: half of its words are upper case and it holds ``!!``;
* ``stutter``: half of its words equal the word before;
* ``repeated``: it equals an earlier line of the text.

A document is kept unless its base figures fail (fewer than ``min_words``
words, or more than half of the words in repeated three-word windows) or the
removed lines hold more than ``max_lost`` of its word characters, or leave fewer than ``min_left`` words. Boilerplate
lines do not count as lost text of the document: a licence note says nothing
about the prose around it (a document of notes only loses everything).

Every figure covers the whole text. All work is on one row at a time (no
shuffle); texts are handled in slices of bounded size.

Defined cases: null and empty texts have no words and are not kept; null ids
stay null; repeated rows are judged one by one; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import per_text, quoted, segment_sum, slices, small_batches, table, words_of

MIN_LEFT = 10       # words
SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*$"
SYMBOL_RUN = r"[#*$%&|<>~^=+_]{2,}"
SEPARATOR = r"^[|»«›‹·•/\\>→-]+$"
MENU = r"^(?i:home|menu|login|logout|sign|register|search|contact|about|faq|sitemap|next|previous|share|help)[|,:»]?$"
BOILERPLATE = (r"(?i)(all rights reserved|licen[sc]ed under|general public license|apache license"
               r"|mit license|creative commons|terms of (use|service)|privacy policy"
               r"|cookies? (policy|settings|notice)|uses? cookies|enable javascript|javascript is"
               r"|copyright (©|\(c\)|[0-9]{4})|subscribe to|click here|powered by)")
RULES = ("punctuation", "navigation", "boilerplate", "symbols", "shouting", "stutter", "repeated")


def repeated_windows(codes: np.ndarray, starts: np.ndarray, distinct: int) -> np.ndarray:
    """Per text: words in 3-word windows that occur twice or more in the text."""
    n = len(codes)
    if n < 3:
        return np.zeros(len(starts) - 1, np.int64)
    if distinct < (1 << 21):
        gram = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    else:  # a very long text: number the pairs first
        pair = np.unique(codes[:-1] * distinct + codes[1:], return_inverse=True)[1]
        gram = np.unique(pair[:-1] * distinct + codes[2:], return_inverse=True)[1]
    text = per_text(starts)
    at = np.flatnonzero(text[:-2] == text[2:])
    order = at[np.lexsort((gram[at], text[at]))]
    same = (gram[order][1:] == gram[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(n, bool)
    found = order[twice]
    for k in range(3):
        hit[found + k] = True
    return segment_sum(hit.astype(np.int64), starts)


def judge(texts: pa.Array) -> dict[str, np.ndarray]:
    """Figures of every text; ``failed`` per line under ``lines``."""
    parts = pc.split_pattern(texts, "\n")
    lines, first = parts.flatten(), np.asarray(parts.offsets, dtype=np.int64)
    first = first - first[0]
    flat, starts = words_of(lines)
    d = flat.dictionary_encode()
    words, codes = d.dictionary, np.asarray(d.indices, dtype=np.int64)

    def each(kernel, *args) -> np.ndarray:
        return np.asarray(kernel(words, *args))[codes].astype(np.int64)

    def holds(pattern: str) -> np.ndarray:
        return segment_sum(each(pc.match_substring_regex, pattern), starts)

    chars = each(pc.utf8_length)
    line_chars = segment_sum(chars, starts)
    n = np.diff(starts)
    some = n > 0
    upper = np.asarray(pc.and_(pc.equal(words, pc.utf8_upper(words)),
                               pc.invert(pc.equal(words, pc.utf8_lower(words)))))
    stutter = np.zeros(len(codes), np.int64)
    if len(codes):
        line_of = per_text(starts)
        stutter[1:] = (codes[1:] == codes[:-1]) & (line_of[1:] == line_of[:-1])
    numbers = np.asarray(lines.dictionary_encode().indices, dtype=np.int64)
    text_of = per_text(first)
    earlier = np.ones(len(numbers), bool)
    if len(numbers):
        key = text_of * (numbers.max() + 1) + numbers
        earlier[np.unique(key, return_index=True)[1]] = False
    earlier &= some
    failed = {
        "punctuation": some & (holds(SENTENCE_END) == 0),
        "navigation": some & ((4 * holds(SEPARATOR) >= n) & (holds(SEPARATOR) > 1)
                              | (2 * holds(MENU) >= n) & (holds(MENU) > 2)),
        "boilerplate": some & np.asarray(pc.match_substring_regex(lines, BOILERPLATE)),
        "symbols": some & (3 * holds(SYMBOL_RUN) >= n),
        "shouting": some & (2 * segment_sum(upper[codes].astype(np.int64), starts) >= n) & (holds("!!") > 0),
        "stutter": some & (n > 3) & (2 * segment_sum(stutter, starts) >= n),
        "repeated": earlier,
    }
    anyhow = np.logical_or.reduce([*failed.values()])
    note = failed["boilerplate"]
    word_first = starts[first]
    return {
        "n_words": np.diff(word_first), "word_chars": segment_sum(chars, word_first),
        "n_symbols": segment_sum(each(pc.count_substring_regex, SYMBOLS), word_first),
        "n_dup_lines": segment_sum(earlier.astype(np.int64), first),
        "n_repeat_words": repeated_windows(codes, word_first, len(words)),
        "lost_chars": segment_sum(line_chars * anyhow, first),
        "lost_notes": segment_sum(line_chars * note, first),
        "n_failed_lines": segment_sum(anyhow.astype(np.int64), first),
        "left_words": segment_sum(n * ~anyhow, first),
        "lines": (lines, first, failed, anyhow),
    }


def clean_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = 50,
                max_lost: float = 0.5, min_left: int = MIN_LEFT, with_text: bool = True) -> DataFrame:
    """Figures, verdict and (``with_text``) the text without its failed lines."""
    small_batches(docs.sparkSession)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
              "n_failed_lines", "lost_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            x = judge(texts)
            base = (x["n_words"] < min_words) | (100 * x["n_repeat_words"] > 50 * x["n_words"])
            lost, own = x["lost_chars"] - x["lost_notes"], x["word_chars"] - x["lost_notes"]
            kept = ~base & (x["left_words"] >= min_left) & (own > 0) & (lost <= max_lost * own)
            cols = [rows.column(1), *(pa.array(x[c]) for c in counts), pa.array(base), pa.array(kept)]
            names = ["id", *counts, "base_failed", "kept"]
            if with_text:
                lines, first, _, anyhow = x["lines"]
                left = lines.filter(pa.array(~anyhow))
                offsets = np.concatenate(([0], np.cumsum(~anyhow)))[first]
                lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), left)
                cols.append(pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string()))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.select(quoted(id_col)).schema[0].dataType.simpleString()
    schema = f"id {kind}, {', '.join(f'{c} long' for c in counts)}, base_failed boolean, kept boolean"
    out = docs.select(quoted(text_col).alias("text"), quoted(id_col).alias("id")).mapInArrow(
        run, schema + (", clean_text string" if with_text else ""))
    return out.withColumnRenamed("id", id_col)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = clean_lines(table(spark, sf_dir, "documents"), with_text=False)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_failed_lines", "lost_chars")


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _count(condition: str) -> str:
    return f"len([x FOR x IN w IF {condition}])"


def _matching(pattern: str) -> str:
    return _count(f"regexp_matches(x, {_sql_text(pattern)})")


SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, i, ls[i] AS line,
        [x FOR x IN regexp_split_to_array(ls[i], '[\x20\x09-\x0D]+') IF x <> ''] AS w
      FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT rid, i, w, len(w) AS n, coalesce(list_sum([length(x) FOR x IN w]), 0) AS chars,
        row_number() OVER (PARTITION BY rid, line ORDER BY i) > 1 AS seen,
        regexp_matches(line, {_sql_text(BOILERPLATE)}) AS note,
        {_matching(SENTENCE_END)} AS ends, {_matching(SEPARATOR)} AS seps, {_matching(MENU)} AS menus,
        {_matching(SYMBOL_RUN)} AS runs, {_matching("!!")} AS bangs,
        {_count("x = upper(x) AND x <> lower(x)")} AS uppers,
        len([j FOR j IN range(2, len(w) + 1) IF w[j] = w[j - 1]]) AS same
      FROM l),
g AS (SELECT *, n > 0 AND (ends = 0 OR (4 * seps >= n AND seps > 1) OR (2 * menus >= n AND menus > 2)
        OR note OR 3 * runs >= n OR (2 * uppers >= n AND bangs > 0) OR (n > 3 AND 2 * same >= n) OR seen) AS failed
      FROM f),
s AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n_words, CAST(sum(chars) AS BIGINT) AS word_chars,
        count(*) FILTER (WHERE seen AND n > 0) AS n_dup_lines, count(*) FILTER (WHERE failed) AS n_failed_lines,
        coalesce(sum(n) FILTER (WHERE NOT failed), 0) AS left_words,
        CAST(coalesce(sum(chars) FILTER (WHERE failed), 0) AS BIGINT) AS lost_chars,
        CAST(coalesce(sum(chars) FILTER (WHERE note AND n > 0), 0) AS BIGINT) AS notes,
        flatten(list(w ORDER BY i)) AS w
      FROM g GROUP BY rid),
k AS (SELECT rid, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM s)),
r AS (SELECT rid, count(DISTINCT q) AS n_repeat_words
      FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q
            FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS m FROM k) WHERE m > 1) GROUP BY rid),
o AS (SELECT doc_id, n_words, word_chars,
        CAST(coalesce(list_sum([length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) FOR x IN w]), 0) AS BIGINT) AS n_symbols,
        n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_failed_lines, lost_chars, notes, left_words
      FROM s JOIN d USING (rid) LEFT JOIN r USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars > notes AND left_words >= {MIN_LEFT}
    AND lost_chars - notes <= 0.5 * (word_chars - notes) AS kept, n_failed_lines, lost_chars
FROM o
"""

QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES = {"op8_quality_rules": SQL}
