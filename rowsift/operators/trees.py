"""Growth of random trees inside one task: the numpy half of :mod:`.forest`.

A node's rows are kept together; every level splits all its nodes at once. Rows are binned feature
vectors ``x`` (n, d). For classes ``y`` is a class index and ``w`` a weight; for regression ``w``
is the weight and ``y`` the weighted sum of the targets of the rows that ``x`` row stands for.
"""

from __future__ import annotations

import math

import numpy as np

GAIN = 1e-12                  # a smaller gain is rounding
HIST_CELLS = 1 << 16          # cells of the histograms held at once
ROW_CELLS = 8                 # cells of a histogram that cost less than to sort a row
POISSON: dict[int, tuple[int, np.ndarray]] = {}


# ---------------------------------------------------------------- bootstrap

def _poisson_table(m: int) -> tuple[int, np.ndarray]:
    """First value and cumulated probabilities of Poisson(m), to the last bit that counts."""
    if m not in POISSON:
        lo = max(0, int(m - 10 * math.sqrt(m) - 10))
        k = np.arange(lo + 1, int(m + 10 * math.sqrt(m) + 30))
        first = -m + lo * math.log(m) - math.lgamma(lo + 1)
        POISSON[m] = lo, np.cumsum(np.exp(np.concatenate([[first], first + np.cumsum(np.log(m / k))])))
    return POISSON[m]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def bootstrap(h: np.ndarray, copies: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: Poisson(1) for every copy, so Poisson(copies) for all of them,
    from the rows' hashes alone (the same however the rows are dealt out)."""
    salt = np.array([(seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64], np.uint64)
    u = (_mixed(h + _mixed(salt)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
    out = np.empty(len(h), np.int64)
    for m in np.unique(copies):
        lo, table = _poisson_table(int(m))
        at = copies == m
        out[at] = lo + np.searchsorted(table, u[at], side="right")
    return out


# ---------------------------------------------------------------- one level

def subsets(rng, nodes: int, d: int, s: int) -> np.ndarray:
    """(nodes, s) distinct features drawn for every node."""
    if s >= d:
        return np.tile(np.arange(d), (nodes, 1))
    return np.argpartition(rng.random((nodes, d), np.float32), s, axis=1)[:, :s]


def _drawn(rngs: list, tree: np.ndarray, open_: np.ndarray, d: int, s: int) -> np.ndarray:
    """:func:`subsets` of the open nodes of a level, every tree's nodes drawn by its own generator."""
    if s >= d:
        return np.tile(np.arange(d), (int(open_.sum()), 1))
    u = np.empty((len(tree), d), np.float32)
    ends = np.searchsorted(tree, np.arange(len(rngs) + 1))
    some = np.bincount(tree[open_], minlength=len(rngs))
    for t in np.flatnonzero(some):
        rngs[t].random(dtype=np.float32, out=u[ends[t]:ends[t + 1]])
    return np.argpartition(u[open_], s, axis=1)[:, :s]


def class_scores(w, own, cross, total, squares):
    """Gain of every cut of a node from cumulated weights of the left side: rows ``w``, sum of squared class
    weights ``own``, sum of left x whole class weights ``cross``."""
    right = total[:, None] - w
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (own / w + (squares[:, None] - 2 * cross + own) / right - (squares / total)[:, None]) / total[:, None]
    return np.where((w > 0) & (right > 0), gain, -np.inf)


def value_scores(w, y, total, sums):
    """Gain of every cut of a node (fall of the variance) from cumulated weights and target sums."""
    right = total[:, None] - w
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (y * y / w + (sums[:, None] - y) ** 2 / right - (sums * sums / total)[:, None]) / total[:, None]
    return np.where((w > 0) & (right > 0), gain, -np.inf)


def _first_best(gain: np.ndarray, node: np.ndarray, nodes: int) -> np.ndarray:
    """Place of the first highest gain of every node; ``node`` ascends and has them all."""
    top = np.maximum.reduceat(gain, np.searchsorted(node, np.arange(nodes)))
    at = np.flatnonzero(gain == top[node])
    return at[np.searchsorted(node[at], np.arange(nodes))]


def _by_histograms(node, cls, ww, total, sumsq, classes: int, bins: int):
    """For nodes of many rows: a function of the rows' bins by one feature that gives (gain, cut) of every node, from
    its histogram by class. ``node`` ascends. Weights are whole numbers, so sums are exact."""
    m, step = len(total), max(1, min(len(total), HIST_CELLS // (classes * bins)))
    ends = np.searchsorted(node, np.arange(0, m + step, step))
    at = cls * step + node % step

    def run(b):
        gain, cut = np.empty(m), np.empty(m, np.int64)
        for i, lo in enumerate(range(0, m, step)):
            r, mine = slice(ends[i], ends[i + 1]), slice(lo, min(m, lo + step))
            left = np.bincount(b[r] * (classes * step) + at[r], ww[r], bins * classes * step).reshape(bins, classes, step)[:, :, :mine.stop - lo]
            for j in range(1, bins):
                left[j] += left[j - 1]
            sums = left.sum(axis=1), (left * left).sum(axis=1), (left * left[-1]).sum(axis=1)
            got = class_scores(*(np.ascontiguousarray(v.T) for v in sums), total[mine], sumsq[mine])
            cut[mine] = got.argmax(axis=1)
            gain[mine] = got[np.arange(len(got)), cut[mine]]
        return gain, cut
    return run


def _by_sorting(node, seg, ww, per, total, sumsq, bins: int):
    """The same for nodes of few rows, from their rows in the order of their bins. Rows are in order of (node, class), ``seg``
    numbers these pairs, ``per`` is the weight of a row's pair."""
    m, n = len(total), len(node)
    bits, wide = int(n).bit_length(), int(bins - 1).bit_length()
    low, mask = (1 << bits) - 1, (1 << wide) - 1
    segs, nodes = seg << (bits + wide) | np.arange(n), node << (bits + wide) | np.arange(n)
    new = np.concatenate([[True], seg[1:] != seg[:-1]])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    starts = np.searchsorted(node, np.arange(m))

    def run(b):
        packed = segs | (b << bits)
        packed.sort()
        ws = ww[packed & low]
        said = np.cumsum(ws) - ws
        own = (2 * (said - said[first]) + ws) * ws
        packed = nodes | ((packed >> bits & mask) << bits)      # the rows of a pair stay in its places
        packed.sort()
        by, key = packed & low, packed >> bits
        last = np.flatnonzero(np.concatenate([key[1:] != key[:-1], [True]]))
        key = key[last]
        of, cuts = key >> wide, key & mask
        sums = []
        for v in (ws, own, per * ws):
            c = np.cumsum(v[by])
            before = c[starts - 1]
            before[0] = 0
            sums.append(c[last] - before[of])
        gain = class_scores(*(v[:, None] for v in sums), total[of], sumsq[of])[:, 0]
        best = _first_best(gain, of, m)
        return gain[best], cuts[best]
    return run


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, squares: np.ndarray | None, *, classes: int, bins: int, s: int,
         depth: int, max_depth: int, rng, row: np.ndarray | None = None, root: np.ndarray | None = None) -> dict:
    """A tree over these rows, its root ``depth`` levels below the tree's own. ``classes`` 0: regression,
    where ``squares`` are the rows' weighted squared targets.

    Several class trees grow together where ``rng`` is a list with a generator for each: ``row`` are then the rows that
    they draw, ``w`` the weights of these draws, ``root`` the tree of each; node t is the root of tree t.

    Returns flat arrays: feature (-1: leaf), cut, left (the right child follows), start/stop of a leaf's
    (cls, p) entries, and the importance of each feature."""
    d = x.shape[1]
    rngs = rng if isinstance(rng, list) else [rng]
    row = np.arange(len(x)) if row is None else row
    node, m = np.zeros(len(row), np.int64) if root is None else root, len(rngs)
    tree = np.arange(m)
    middle = 0.0
    if not classes:
        middle = float(y.sum() / w.sum())
        squares = squares - 2 * middle * y + middle * middle * w
        y = y - middle * w
    ww = w.astype(np.float64)
    levels = []
    while m:
        total = np.bincount(node, ww, m)
        if classes:
            bits = int(len(row)).bit_length()
            packed = np.sort((node * classes + y[row]) << bits | np.arange(len(row)))
            order = packed & ((1 << bits) - 1)
            key = packed >> bits
            row, node, ww = row[order], node[order], ww[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            seg = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            per = np.bincount(seg, ww)
            seg_node, seg_cls = node[first], key[first] % classes
            sumsq = np.bincount(seg_node, per * per, m)
            impure = sumsq < total * total
            pred = seg_cls[_first_best(per, seg_node, m)]
            level = {"seg_node": seg_node, "seg_cls": seg_cls, "p": per / total[seg_node], "pred": pred}
        else:
            sums = np.bincount(node, y[row], m)
            spread = np.bincount(node, squares[row], m) / total - (sums / total) ** 2
            scale = np.bincount(node, squares[row], m) / total
            impure = spread > GAIN * np.maximum(scale, 1e-300)
            pred = sums / total + middle
            level = {"seg_node": np.arange(m), "seg_cls": np.zeros(m, np.int32), "p": pred, "pred": pred}
        best = np.full(m, -np.inf)
        feat, cut = np.full(m, -1, np.int32), np.zeros(m, np.int64)
        if depth < max_depth and impure.any():
            if classes:
                mixed = np.flatnonzero(impure)
                drawn = _drawn(rngs, tree, impure, d, s)
                many = np.bincount(node, minlength=m)[mixed] * ROW_CELLS >= classes * bins
                for chosen in (many, ~many):
                    nodes = mixed[chosen]
                    if not len(nodes):
                        continue
                    picked = np.zeros(m, bool)
                    picked[nodes] = True
                    mine = np.flatnonzero(picked[node])
                    of, at, own_w, own_seg = (np.cumsum(picked) - 1)[node[mine]], row[mine], ww[mine], seg[mine]
                    if chosen is many:
                        splits = _by_histograms(of, y[at], own_w, total[nodes], sumsq[nodes], classes, bins)
                    else:
                        splits = _by_sorting(of, own_seg, own_w, per[own_seg], total[nodes], sumsq[nodes], bins)
                    found, which, where = np.full(len(nodes), -np.inf), np.full(len(nodes), -1, np.int32), np.zeros(len(nodes), np.int64)
                    for f in drawn[chosen].T:
                        got, cuts = splits(x[at, f[of]].astype(np.int64))
                        better = got > found
                        found[better], which[better], where[better] = got[better], f[better], cuts[better]
                    best[nodes], feat[nodes], cut[nodes] = found, which, where
                worth = best > GAIN
            else:
                drawn = subsets(rngs[0], m, d, s)
                for j in range(s):
                    f = drawn[:, j]
                    b = x[row, f[node]].astype(np.int64)
                    cell = node * bins + b
                    hist = [np.bincount(cell, v, m * bins).reshape(m, bins).cumsum(axis=1) for v in (ww, y[row])]
                    gain = value_scores(*hist, total, sums)
                    at = gain.argmax(axis=1)
                    got = gain[np.arange(m), at]
                    better = impure & (got > best)
                    best[better], feat[better], cut[better] = got[better], f[better], at[better]
                worth = best > GAIN * np.maximum(scale, 1e-300)
            feat[~worth] = -1
        level |= {"feat": feat, "cut": cut, "gain": np.where(feat >= 0, best * total, 0.0)}
        levels.append(level)
        rank = np.cumsum(feat >= 0) - 1
        stay = feat[node] >= 0
        row, node, ww = row[stay], node[stay], ww[stay]
        node = 2 * rank[node] + (x[row, feat[node]] > cut[node])
        tree = np.repeat(tree[feat >= 0], 2)
        m, depth = len(tree), depth + 1
    return _flat(levels, d)


def _flat(levels: list[dict], d: int) -> dict:
    """One array per column. Twin leaves with one prediction are merged into their parent, bottom up."""
    for upper, lower in zip(levels[-2::-1], levels[:0:-1]):
        split = np.flatnonzero(upper["feat"] >= 0)
        leaf, pred = lower["feat"].reshape(-1, 2) < 0, lower["pred"].reshape(-1, 2)
        same = leaf.all(axis=1) & (pred[:, 0] == pred[:, 1])
        upper["rank"] = np.full(len(upper["feat"]), -1)
        upper["rank"][split] = np.arange(len(split))
        upper["feat"][split[same]] = -1
    out = {k: [] for k in ("feature", "cut", "left", "start", "stop", "cls", "p")}
    importance = np.zeros(d)
    alive, base, said = np.ones(len(levels[0]["feat"]), bool), 0, 0
    for i, lv in enumerate(levels):
        kept = np.flatnonzero(alive)
        feat = lv["feat"][kept]
        split = feat >= 0
        after = base + len(kept)
        out["feature"].append(feat)
        out["cut"].append(lv["cut"][kept])
        out["left"].append(np.where(split, after + 2 * (np.cumsum(split) - 1), -1))
        np.add.at(importance, feat[split], lv["gain"][kept][split])
        leaf = np.zeros(len(lv["feat"]), bool)
        leaf[kept[~split]] = True
        mine = leaf[lv["seg_node"]]
        sizes = np.bincount(lv["seg_node"][mine], minlength=len(leaf))[kept]
        stop = said + np.cumsum(sizes)
        out["start"].append(stop - sizes)
        out["stop"].append(stop)
        out["cls"].append(lv["seg_cls"][mine])
        out["p"].append(lv["p"][mine])
        said, base = said + int(sizes.sum()), after
        if i + 1 < len(levels):
            alive = np.zeros(len(levels[i + 1]["feat"]), bool)
            first = 2 * lv["rank"][kept[split]]
            alive[first] = alive[first + 1] = True
    kinds = {"feature": np.int32, "cut": np.uint16, "left": np.int32, "start": np.int32, "stop": np.int32, "cls": np.int32,
             "p": np.float64}
    return {k: np.concatenate(v).astype(kinds[k]) for k, v in out.items()} | {"importance": importance}


# ---------------------------------------------------------------- use

def route(tree: dict, x: np.ndarray, roots: int = 1) -> np.ndarray:
    """Node in which every row ends; of several trees that grew together, tree by tree."""
    at = np.repeat(np.arange(roots), len(x))
    todo, row = np.arange(len(at)), np.tile(np.arange(len(x)), roots)
    feature, cut, left = tree["feature"], tree["cut"], tree["left"]
    while True:
        todo = todo[feature[at[todo]] >= 0]
        if not len(todo):
            return at
        here = at[todo]
        at[todo] = left[here] + (x[row[todo], feature[here]] > cut[here])


def split_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """Cuts of a feature: between all distinct values, or, of too many, at about equal counts."""
    distinct, counts = np.unique(values, return_counts=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < max_bins:
        return middle
    stride = len(values) / max_bins
    said = np.cumsum(counts)
    halves = (said[:-1] + said[1:]) / 2       # a target below the i-th is nearer to the values up to distinct[i]
    target, i, out = stride, 0, []
    while len(out) < max_bins - 1 and (i := max(i, int(np.searchsorted(halves, target, side="right")))) < len(halves):
        out.append(middle[i])
        target, i = target + stride, i + 1
    return np.array(out)
