"""Hashed linear model: follow-the-regularised-leader training, sparse scoring.

A text becomes a few families of hashed features. The value of a feature is its
share of the family's occurrences in the text (``share``) or 1 if it occurs at all
(``presence``). The score is the logistic function of bias + sparse dot product.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

DIM_BITS = 18
DIM = 1 << DIM_BITS

# family -> (hash of every occurrence, offsets per text)
Families = list[tuple[np.ndarray, np.ndarray]]
Featurise = Callable[[pa.Array], Families]


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DIM_BITS)).astype(np.int64)


def sparse_rows(families: Families, presence: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct slots, values) of every text; those of ``presence`` are one shared 1."""
    n = len(families[0][1]) - 1
    one = np.ones(1, np.float32)
    out = []
    for t in range(n):
        idx, val = [], []
        for hashes, starts in families:
            a, b = starts[t], starts[t + 1]
            if b > a:
                u, c = np.unique(slots(hashes[a:b]), return_counts=True)
                idx.append(u)
                if not presence:
                    val.append(c / (b - a))
        at = np.concatenate(idx).astype(np.int32) if idx else np.zeros(0, np.int32)
        if presence:
            out.append((at, np.broadcast_to(one, len(at))))
        else:
            out.append((at, np.concatenate(val).astype(np.float32) if val else np.zeros(0, np.float32)))
    return out


def margins(families: Families, weights: np.ndarray, bias: float, presence: bool) -> np.ndarray:
    """bias + dot product for every text, as sums over the occurrences."""
    n = len(families[0][1]) - 1
    total = np.full(n, bias)
    for hashes, starts in families:
        at, length = slots(hashes), np.diff(starts)
        w = weights[at].astype(np.float64)
        if presence:
            hot = np.flatnonzero(w)
            text = np.searchsorted(starts, hot, "right") - 1
            _, once = np.unique(text * DIM + at[hot], return_index=True)
            total += np.bincount(text[once], w[hot][once], n)[:n]
        else:
            run = np.concatenate(([0.0], np.cumsum(w)))
            total += (run[starts[1:]] - run[starts[:-1]]) / np.maximum(length, 1)
    return total


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int, alpha: float,
         beta: float, l1: float, l2: float, seed: int = 7) -> tuple[np.ndarray, float]:
    """FTRL-proximal: per-coordinate rates, L1 and L2; soft labels allowed.

    ``z`` and ``n`` keep one extra slot for the bias, which is not regularised."""
    z, n = np.zeros(DIM + 1), np.zeros(DIM + 1)
    rng = np.random.default_rng(seed)

    def weight(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    def bias():
        return -z[DIM] / ((beta + np.sqrt(n[DIM])) / alpha)

    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            i, x = rows[r]
            w, b = weight(i), bias()
            g = 1.0 / (1.0 + np.exp(-np.clip(w @ x + b, -35, 35))) - labels[r]
            gx = g * x
            s = (np.sqrt(n[i] + gx * gx) - np.sqrt(n[i])) / alpha
            z[i] += gx - s * w
            n[i] += gx * gx
            s = (np.sqrt(n[DIM] + g * g) - np.sqrt(n[DIM])) / alpha
            z[DIM] += g - s * b
            n[DIM] += g * g
    return weight(np.arange(DIM)), float(bias())
