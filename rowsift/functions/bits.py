"""Seeded hashing and bit-packed solution masks.

A population of P candidate subsets is stored *transposed*: every data row
carries ``ceil(P / WORD_BITS)`` bigint columns ``mask_0, mask_1, ...``; bit
``s % WORD_BITS`` of word ``s // WORD_BITS`` says whether solution ``s`` keeps
the row. All randomness is a pure function of (seed, tag, row_id), so results do
not depend on partitioning and recomputation after executor loss is exact.

The same hash is written in SQL by :func:`sql_seeded_hash` so DuckDB oracles
reproduce the Spark values bit for bit.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Hash width in bits (15 hex digits of md5) and solutions per word.
HASH_BITS = 60
HASH_RANGE = 1 << HASH_BITS
WORD_BITS = 60


def seeded_hash(seed: int, tag: str, *cols) -> Column:
    """Uniform 60-bit non-negative bigint of ``md5('seed:tag:c1:c2...')``."""
    parts = [F.lit(str(seed)), F.lit(tag)] + [F.col(c).cast("string") if isinstance(c, str)
                                             else c.cast("string") for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def sql_seeded_hash(seed: int, tag: str, *exprs: str) -> str:
    """DuckDB spelling of :func:`seeded_hash`."""
    inner = " || ':' || ".join([f"'{seed}:{tag}'"] + [f"CAST({e} AS VARCHAR)" for e in exprs])
    return f"CAST(('0x' || substr(md5({inner}), 1, 15)) AS BIGINT)"


# Odd multipliers below 2**31, so that products of 32-bit numbers fit a bigint.
KEY_BITS = 32
_LOW = (1 << KEY_BITS) - 1
_MULTIPLIERS = (0x7FEB352D, 0x31848BAB, 0x2C1B3C6D)


def _keyed(ident: str, key0: int, key1: int, xor: str) -> str:
    a, b, c = _MULTIPLIERS
    x = f"(((({ident} & {_LOW}) + {key0}) & {_LOW}) * {a} & {_LOW})"
    x = f"((({xor.format(x, f'({x} >> 15)')} + ({ident} >> {KEY_BITS}) + {key1}) & {_LOW}) * {b} & {_LOW})"
    return f"({xor.format(x, f'({x} >> 14)')} * {c} & {_LOW})"


def keyed_hash(id_col: str, key0: int, key1: int) -> str:
    """Spark SQL text of a keyed 32-bit hash of a non-negative bigint: multiplications and
    shifted xors in generated code, a permutation of ids that agree above 32 bits."""
    return _keyed(f"`{id_col}`", key0, key1, "({} ^ {})")


def sql_keyed_hash(id_expr: str, key0: int, key1: int) -> str:
    """DuckDB spelling of :func:`keyed_hash`."""
    return _keyed(f"CAST({id_expr} AS BIGINT)", key0, key1, "xor({}, {})")


def keyed_hashes(ids: np.ndarray, key0: int, key1: int) -> np.ndarray:
    """:func:`keyed_hash` of an int64 array."""
    a, b, c = _MULTIPLIERS
    x = ((ids & _LOW) + key0 & _LOW) * a & _LOW
    x = ((x ^ (x >> 15)) + (ids >> KEY_BITS) + key1 & _LOW) * b & _LOW
    return (x ^ (x >> 14)) * c & _LOW


# Spark's xxhash64 (XXH64 with seed 42, of which every column's hash is the next one's seed).
_XX = [np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _xx_end(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _XX[1]
    h = (h ^ (h >> np.uint64(29))) * _XX[2]
    return h ^ (h >> np.uint64(32))


def xxhash64_rows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``xxhash64(x, y)`` of every row's bytes ``x`` (n, bytes; uint8) and its int ``y``, as uint64."""
    p1, p2, p3, p4, p5 = _XX
    n, size = x.shape
    seed = np.full(n, 42, np.uint64)
    words = np.ascontiguousarray(x[:, :size // 8 * 8]).view("<u8").reshape(n, size // 8)
    done = 0
    if size >= 32:
        v = [seed + p1 + p2, seed + p2, seed, seed - p1]
        for done in range(4, size // 32 * 4 + 1, 4):
            v = [_rotl(a + words[:, done - 4 + i] * p2, 31) * p1 for i, a in enumerate(v)]
        h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for a in v:
            h = (h ^ (_rotl(a * p2, 31) * p1)) * p1 + p4
    else:
        h = seed + p5
    h = h + np.uint64(size)
    for i in range(done, size // 8):
        h = _rotl(h ^ (_rotl(words[:, i] * p2, 31) * p1), 27) * p1 + p4
    at = size // 8 * 8
    if at + 4 <= size:
        four = np.ascontiguousarray(x[:, at:at + 4]).view("<u4")[:, 0].astype(np.uint64)
        h, at = _rotl(h ^ (four * p1), 23) * p2 + p3, at + 4
    for i in range(at, size):
        h = _rotl(h ^ (x[:, i].astype(np.uint64) * p5), 11) * p1
    h = _xx_end(h) + p5 + np.uint64(4)
    return _xx_end(_rotl(h ^ (y.astype(np.uint32).astype(np.uint64) * p1), 23) * p2 + p3)


def n_words(population: int) -> int:
    return (population + WORD_BITS - 1) // WORD_BITS


def word_cols(population: int) -> list[str]:
    return [f"mask_{w}" for w in range(n_words(population))]


def getbit(s: int) -> Column:
    """0/1 (bigint) membership of the current row in solution ``s``."""
    w, b = divmod(s, WORD_BITS)
    return F.shiftright(F.col(f"mask_{w}"), b).bitwiseAND(F.lit(1))


def sql_getbit(s: int, alias: str = "") -> str:
    w, b = divmod(s, WORD_BITS)
    pre = f"{alias}." if alias else ""
    return f"(({pre}mask_{w} >> {b}) & 1)"


def pack_bits(bits: list[Column]) -> list[Column]:
    """Pack one 0/1 column per solution into mask words (``mask_0``...)."""
    out = []
    for w in range(n_words(len(bits))):
        chunk = bits[w * WORD_BITS:(w + 1) * WORD_BITS]
        acc = None
        for b, bit in enumerate(chunk):
            term = F.shiftleft(bit.cast("bigint"), b) if b else bit.cast("bigint")
            acc = term if acc is None else acc.bitwiseOR(term)
        out.append(acc.alias(f"mask_{w}"))
    return out


def random_masks(seed: int, population: int, id_col: str = "row_id") -> list[Column]:
    """Initial population: every bit an independent fair coin of (seed, word, row)."""
    out = []
    for w in range(n_words(population)):
        width = min(WORD_BITS, population - w * WORD_BITS)
        h = seeded_hash(seed, f"init{w}", id_col)
        out.append(h.bitwiseAND(F.lit((1 << width) - 1)).alias(f"mask_{w}"))
    return out


def sql_random_masks(seed: int, population: int, id_expr: str = "row_id") -> list[str]:
    out = []
    for w in range(n_words(population)):
        width = min(WORD_BITS, population - w * WORD_BITS)
        out.append(f"({sql_seeded_hash(seed, f'init{w}', id_expr)} & {(1 << width) - 1}) AS mask_{w}")
    return out
