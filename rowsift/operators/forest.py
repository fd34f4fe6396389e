"""Random forests grown by Spark: bootstrap trees of gini (or variance) splits over binned features.

1. Features are binned at ``max_bins`` quantiles. Rows of equal bins and label become one *cell* with a count; all
   later steps work on cells, in order of their bins.
2. Each tree draws every cell Poisson(count) times, by a hash of the cell and the tree, so no draw is stored.
3. Top: while a node holds more than ``group_rows`` cells, tasks add up its histograms and one aggregate per node
   chooses the split; the driver holds these few nodes only.
4. Below: the cells of a smaller node go to one task (``groupBy(tree, node)``), which grows the whole subtree there
   and returns it as a row of arrays. So a group has at most ``group_rows`` cells at any table size, and the grown
   trees, 100 times the table, stay a distributed table.
5. Prediction deals distinct binned vectors to the subtrees they end in, and adds up the leaves' votes.
6. Many small forests, each over a part of one table, are grown and tried in one job (:func:`score_small`): tasks get a
   part's rows and grow some of its trees side by side, the same trees as steps 1 to 5 give.

Labels may be any integers; they are mapped to class indices 0..K-1 with a
small literal map (K is bounded) and predictions are mapped back.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bits import WORD_BITS, xxhash64_rows
from ..functions.literals import lookup
from ..session import write_once
from . import metrics
from .classes import require_classes
from .knn import arrow_matrix
from .trees import bootstrap, class_scores, grow, route, split_points, subsets, value_scores

MAX_SPARK_DEPTH = 30
GROUP_ROWS = 1 << 16          # cells of a node that one task grows
SPLIT_SAMPLE = 10_000         # rows from which quantiles are taken, at least
HIST_BYTES = 64 << 20         # histograms a task holds at once
TASK_ROWS = 1 << 14           # rows of subtrees that are worth a task
LEAST_ROWS = 1 << 11          # rows of a table that are worth a task
AT_ONCE = 4                   # forests whose Spark jobs run side by side
SMALL_BYTES = 64 << 20        # features of a forest that a task may hold whole
VOTE_BYTES = 8 << 20          # votes on its held-out rows
DRAWN_ROWS = 1 << 15          # drawn rows of the trees that a task grows together
LEAST_TREES = 8               # trees that are worth another copy of the rows
PART_FIELDS = {"feature": np.int32, "cut": np.uint16, "left": np.int32, "start": np.int32, "stop": np.int32,
               "cls": np.int32, "p": np.float64, "importance": np.float64}
PART_SCHEMA = "tree int, node long, " + ", ".join(f"{k} binary" for k in PART_FIELDS)
PACKET_SCHEMA = "tree int, node long, salt int, n int, x binary, a binary, b binary, c binary"


@dataclass
class Settings:
    """What tasks need to know of a forest."""
    classes: int              # 0: regression
    d: int
    bins: int
    s: int                    # features drawn for a node
    trees: int
    seed: int
    max_depth: int


@dataclass
class TopTree:
    """The nodes of a tree above the subtrees (driver side): a leaf here is the root of one."""
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    left: list = field(default_factory=lambda: [-1])
    depth: list = field(default_factory=lambda: [0])
    size: list = field(default_factory=lambda: [0])     # distinct cells

    def arrays(self) -> dict:
        return {"feature": np.array(self.feature), "cut": np.array(self.cut), "left": np.array(self.left)}


@dataclass
class Forest:
    settings: Settings
    edges: list               # cuts of every feature
    tops: list
    gains: np.ndarray         # (trees, d) importance from the top nodes
    parts: DataFrame          # PART_SCHEMA, cached

    def importances(self) -> np.ndarray:
        """Gains by feature, of equal weight from every tree with a split, summing to 1."""
        rows = self.parts.select("tree", "importance").mapInArrow(_importance(self.settings), "tree int, feature int, gain double")
        gains = self.gains.copy()
        for r in rows.groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect():
            gains[r["tree"], r["feature"]] += r["gain"]
        whole = gains.sum(axis=1, keepdims=True)
        each = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)
        return each / each.sum() if each.sum() > 0 else each


@dataclass
class ForestModel:
    model: Forest
    task: str
    classes: list | None
    training_time: float
    timestamp: pd.Timestamp
    feature_col: str = "features"
    settings: dict | None = None     # what the forest was fitted with

    def release(self) -> None:
        """Free the cached trees; predictions must have been consumed."""
        self.model.parts.unpersist()


def _index(classes):
    return lookup({c: float(i) for i, c in enumerate(classes)}, F.col("label"))


# ---------------------------------------------------------------- bins and cells

def _edges(data: DataFrame, feature_col: str, n: int, d: int, max_bins: int, seed: int) -> list:
    """Cuts of every feature, from the quantiles of a sample of the rows (all of them up to ``SPLIT_SAMPLE``)."""
    share = max(max_bins * max_bins, SPLIT_SAMPLE) / n
    rows = data.select(feature_col)
    if share < 1:
        rows = rows.sample(False, share, seed)

    def cuts(key, values):
        got = split_points(np.asarray(values.column("v"), np.float64), max_bins)
        return pa.table({"pos": pa.array([key[0].as_py()], pa.int32()), "cuts": pa.array([got.tolist()], pa.list_(pa.float64()))})
    found = (rows.select(F.posexplode(feature_col).alias("pos", "v")).select("pos", F.col("v").cast("double").alias("v"))
             .groupBy("pos").applyInArrow(cuts, "pos int, cuts array<double>").collect())
    out = [np.zeros(0)] * d
    for r in found:
        out[r["pos"]] = np.array(r["cuts"])
    return out


def _binned(df: DataFrame, feature_col: str, edges: list, out_col: str, drop: bool) -> DataFrame:
    """``df`` plus the bins of its features as bytes; ``drop``: in place of the features."""
    at, kind = df.columns.index(feature_col), np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16
    schema = T.StructType([f for f in df.schema.fields if not (drop and f.name == feature_col)]).add(out_col, "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            x = arrow_matrix(rb.column(at))
            if rb.num_rows and x.shape[1] != len(edges):
                raise ValueError(f"{x.shape[1]} features, expected {len(edges)}")
            b = np.zeros((rb.num_rows, len(edges)), kind)
            for j, e in enumerate(edges):
                b[:, j] = np.searchsorted(e, x[:, j], side="left") if len(b) else 0
            size = b.shape[1] * b.itemsize
            data = pa.Array.from_buffers(pa.binary(), rb.num_rows,
                                         [None, pa.py_buffer(np.arange(rb.num_rows + 1, dtype=np.int32) * size), pa.py_buffer(b.tobytes())])
            columns = [c for i, c in enumerate(rb.columns) if not (drop and i == at)] + [data]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
    return df.mapInArrow(run, schema)


def _vectors(column: pa.Array, d: int, kind) -> np.ndarray:
    """(n, d) bins of a binary column."""
    if not len(column):
        return np.zeros((0, d), kind)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind).reshape(len(column), d)


def _kind(st: Settings):
    return np.uint8 if st.bins <= 256 else np.uint16


def _draws(rb: pa.RecordBatch, st: Settings) -> Iterator[tuple]:
    """(tree, x, y, w, squares) of a batch of cells: what each tree draws of it. Regression: rows of equal
    bins, neighbours in the order of the cells, are one."""
    x, y, h = _vectors(rb.column("x"), st.d, _kind(st)), np.asarray(rb.column("y")), np.asarray(rb.column("h")).astype(np.uint64)
    copies = np.asarray(rb.column("copies"))
    if not st.classes:
        new = np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)])
        first = np.flatnonzero(new)
    for tree in range(st.trees):
        w = bootstrap(h, copies, tree, st.seed) if st.trees > 1 else copies
        if st.classes:
            got = np.flatnonzero(w)
            yield tree, x[got], y[got].astype(np.int32), w[got].astype(np.float64), None
        else:
            sums = [np.add.reduceat(v, first) for v in (w.astype(np.float64), w * y, w * y * y)]
            got = np.flatnonzero(sums[0])
            yield tree, x[first[got]], sums[1][got], sums[0][got], sums[2][got]


# ---------------------------------------------------------------- the top of the trees

def _histograms(tops: list[dict], wanted: dict, st: Settings):
    """(tree, node, hist) of a task: for every drawn feature and bin of the wanted nodes the weights by class, or the weight
    and the sums of targets and their squares, and last the cells."""
    channels = (st.classes or 3) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for rb in batches:
            if not rb.num_rows:
                continue
            for tree, x, y, w, squares in _draws(rb, st):
                if tree not in wanted:
                    continue
                at = route(tops[tree], x)
                for node, drawn in wanted[tree].items():
                    mine = np.flatnonzero(at == node)
                    if not len(mine):
                        continue
                    hist = held.setdefault((tree, node), np.zeros((len(drawn), st.bins * channels)))
                    for j, f in enumerate(drawn):
                        cell = x[mine, f].astype(np.int64) * channels
                        if st.classes:
                            hist[j] += np.bincount(cell + y[mine], w[mine], st.bins * channels)
                        else:
                            for c, v in enumerate((w, y, squares)):
                                hist[j] += np.bincount(cell + c, v[mine], st.bins * channels)
                        hist[j] += np.bincount(cell + channels - 1, minlength=st.bins * channels)
        for (tree, node), hist in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([hist.tobytes()], pa.binary())],
                                             names=["tree", "node", "hist"])
    return run


def _best(wanted: dict, st: Settings):
    """Best split of a node from its tasks' histograms: feature -1 if none gains."""
    channels = (st.classes or 3) + 1

    def run(key, rows):
        tree, node = key[0].as_py(), key[1].as_py()
        drawn, hist = wanted[tree][node], 0.0
        for raw in rows.column("hist").to_pylist():
            hist = hist + np.frombuffer(raw, np.float64).reshape(len(drawn), st.bins, channels)
        left = hist.cumsum(axis=1)
        whole = left[:, -1]
        if st.classes:
            k = left[:, :, :-1]
            t = whole[:, None, :-1]
            total, squares = t.sum(axis=2)[:, 0], (t * t).sum(axis=2)[:, 0]
            gain = class_scores(k.sum(axis=2), (k * k).sum(axis=2), (k * t).sum(axis=2), total, squares)
            least = 1e-12
        else:
            total = whole[:, 0]
            gain = value_scores(left[:, :, 0], left[:, :, 1], total, whole[:, 1])
            least = 1e-12 * (whole[0, 2] / total[0])
        j, b = np.unravel_index(int(gain.argmax()), gain.shape)
        found = gain[j, b] > least
        cells = left[j, b, -1], whole[j, -1] - left[j, b, -1]
        row = (tree, node, int(drawn[j]) if found else -1, int(b), float(gain[j, b] * total[j]) if found else 0.0, int(cells[0]), int(cells[1]))
        kinds = {"tree": pa.int32(), "node": pa.int64(), "feature": pa.int32(), "cut": pa.int32(), "gain": pa.float64(), "left": pa.int64(), "right": pa.int64()}
        return pa.table({k: pa.array([v], t) for v, (k, t) in zip(row, kinds.items())})
    return run


def _grow_tops(cells: DataFrame, size: int, st: Settings, group_rows: int) -> tuple[list[TopTree], np.ndarray]:
    """Split every node of more than ``group_rows`` cells; the others are left to tasks."""
    rng = np.random.default_rng(st.seed)
    tops, gains = [TopTree() for _ in range(st.trees)], np.zeros((st.trees, st.d))
    for top in tops:
        top.size[0] = int(size * (-math.expm1(-1) if st.trees > 1 and st.classes else 1.0))
    todo = [(t, 0) for t, top in enumerate(tops) if top.size[0] > group_rows and st.max_depth > 0]
    at_once = max(1, HIST_BYTES // (st.s * st.bins * ((st.classes or 3) + 1) * 8))
    while todo:
        later = []
        for lo in range(0, len(todo), at_once):
            wanted: dict = {}
            for t, node in todo[lo:lo + at_once]:
                wanted.setdefault(t, {})[node] = np.sort(subsets(rng, 1, st.d, st.s)[0])
            hist = cells.mapInArrow(_histograms([t.arrays() for t in tops], wanted, st), "tree int, node long, hist binary")
            found = hist.groupBy("tree", "node").applyInArrow(_best(wanted, st),
                                                              "tree int, node long, feature int, cut int, gain double, left long, right long")
            for r in sorted(found.collect(), key=lambda r: (r["tree"], r["node"])):
                if r["feature"] < 0:
                    continue
                top, node = tops[r["tree"]], r["node"]
                gains[r["tree"], r["feature"]] += r["gain"]
                top.feature[node], top.cut[node], top.left[node] = r["feature"], r["cut"], len(top.feature)
                for cells_below in (r["left"], r["right"]):
                    if cells_below > group_rows and top.depth[node] + 1 < st.max_depth:
                        later.append((r["tree"], len(top.feature)))
                    for column, v in ((top.feature, -1), (top.cut, 0), (top.left, -1), (top.depth, top.depth[node] + 1), (top.size, int(cells_below))):
                        column.append(v)
        todo = later
    return tops, gains


# ---------------------------------------------------------------- the subtrees

def _packet(tree: int, node: int, salt: int, x: np.ndarray, *columns) -> pa.RecordBatch:
    blobs = [x.tobytes(), *[b"" if c is None else c.tobytes() for c in columns]]
    return pa.RecordBatch.from_arrays(
        [pa.array([tree], pa.int32()), pa.array([node], pa.int64()), pa.array([salt], pa.int32()), pa.array([len(x)], pa.int32()),
         *[pa.array([b], pa.binary()) for b in (blobs + [b"", b""])[:4]]], names=["tree", "node", "salt", "n", "x", "a", "b", "c"])


def _by_node(at: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its rows)"""
    if len(at) and (at == at[0]).all():
        yield int(at[0]), np.arange(len(at))
        return
    order = np.argsort(at, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
        if len(rows):
            yield int(at[rows[0]]), rows


def _dealt(tops: list[dict], st: Settings):
    """Packets of what every tree draws, by the subtree it ends in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if not rb.num_rows:
                continue
            for tree, x, y, w, squares in _draws(rb, st):
                for node, mine in _by_node(route(tops[tree], x)):
                    yield _packet(tree, node, 0, x[mine], y[mine], w[mine], None if squares is None else squares[mine])
    return run


def _joined(packets: pa.Table, column: str, kind) -> np.ndarray:
    """The blobs of all packets."""
    return np.concatenate([np.frombuffer(v, kind) for v in packets.column(column).to_pylist()])


def _subtree(depths: list[list], st: Settings):
    """Grows the subtree of a (tree, node) group."""
    def run(key, packets):
        tree, node = key[0].as_py(), key[1].as_py()
        got = packets.sort_by([("x", "ascending"), ("b", "ascending"), ("a", "ascending")])    # whatever the order of arrival
        x = _joined(got, "x", _kind(st)).reshape(-1, st.d)
        y, w = _joined(got, "a", np.int32 if st.classes else np.float64), _joined(got, "b", np.float64)
        squares = None if st.classes else _joined(got, "c", np.float64)
        out = grow(x, y.astype(np.int64) if st.classes else y, w, squares, classes=st.classes, bins=st.bins, s=st.s, depth=depths[tree][node],
                   max_depth=st.max_depth, rng=np.random.default_rng([st.seed, tree, node]))
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int64())}
                        | {k: pa.array([out[k].astype(t).tobytes()], pa.binary()) for k, t in PART_FIELDS.items()})
    return run


def _importance(st: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for tree, raw in zip(rb.column("tree").to_pylist(), rb.column("importance").to_pylist()):
                gain = np.frombuffer(raw, np.float64)
                f = np.flatnonzero(gain)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), tree), pa.int32()), pa.array(f, pa.int32()), pa.array(gain[f])],
                                                 names=["tree", "feature", "gain"])
    return run


def _tasks(spark: SparkSession, groups: int, rows: int) -> int:
    """Tasks for so many groups of so many rows in all: no more than keep the cores busy while they are small."""
    return int(min(2 * groups, 1000, max(4 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))))


def _cell_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for the cells of so many rows. A task sends at least a packet to every tree, so few rows get few tasks."""
    return int(max(1, min(-(-rows // LEAST_ROWS), 4 * spark.sparkContext.defaultParallelism), -(-rows // GROUP_ROWS)))


def fit_forest(train: DataFrame, *, task: str = "classification", num_trees: int = 100,
               max_depth: int = MAX_SPARK_DEPTH, seed: int = 42, feature_col: str = "features",
               max_bins: int = 32, classes: list | None = None, group_rows: int = GROUP_ROWS) -> ForestModel:
    """Fit on ``(label, features array)``. Classification uses gini and sqrt(d)
    features per split, regression all features per split."""
    depth = min(max_depth, MAX_SPARK_DEPTH)
    started = pd.Timestamp.now()
    t0 = time.time()
    if task == "classification":
        if classes is None:
            require_classes(train)
            classes = sorted(r[0] for r in train.select("label").distinct().collect())
        y = _index(classes).cast("int")
    else:
        y = F.col("label").cast("double")
    data = train.select(y.alias("y"), F.col(feature_col).alias("features"))
    size = data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("d"), F.max("y").alias("most")).first()
    if not size["n"]:
        raise IllegalArgumentException("a forest needs rows")
    if task == "classification" and (size["most"] or 0) < 1:
        raise IllegalArgumentException("a classification forest needs at least two classes")
    n, d = size["n"], size["d"]
    max_bins = min(max_bins, n)
    edges = _edges(data, "features", n, d, max_bins, seed)
    st = Settings(len(classes) if task == "classification" else 0, d, max(len(e) for e in edges) + 1,
                  math.ceil(math.sqrt(d)) if task == "classification" and num_trees > 1 else d, num_trees, seed, depth)
    spark = train.sparkSession
    dealt = _cell_tasks(spark, n)
    cells = (_binned(data, "features", edges, "x", True).repartition(dealt, "x", "y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("copies"))
             .select("x", "y", "copies", F.xxhash64("x", "y").alias("h"))
             .repartitionByRange(dealt, "x", "y").sortWithinPartitions("x", "y").persist())
    try:
        distinct = cells.count() if st.classes else cells.select("x").distinct().count()
        tops, gains = _grow_tops(cells, distinct, st, group_rows)
        packets = cells.mapInArrow(_dealt([t.arrays() for t in tops], st), PACKET_SCHEMA).drop("salt", "n")
        groups = sum(f < 0 for top in tops for f in top.feature)
        parts = (packets.repartition(_tasks(spark, groups, distinct * num_trees), "tree", "node").groupBy("tree", "node")
                 .applyInArrow(_subtree([t.depth for t in tops], st), PART_SCHEMA).persist())
        parts.count()
    finally:
        cells.unpersist()
    return ForestModel(Forest(st, edges, tops, gains, parts), task, classes, time.time() - t0, started, feature_col,
                       {"num_trees": num_trees, "max_depth": depth, "seed": seed,
                        "feature_col": feature_col, "max_bins": max_bins})


# ---------------------------------------------------------------- prediction

def _asked(tops: list[dict], salts: list[list], st: Settings):
    """Packets of the vectors of a task by the subtree they end in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            x, ids = _vectors(rb.column("x"), st.d, _kind(st)), np.asarray(rb.column("id"))
            for tree in range(st.trees if len(x) else 0):
                for node, mine in _by_node(route(tops[tree], x)):
                    salt = ids[mine] % salts[tree][node]
                    for part, rows in _by_node(salt):
                        yield _packet(tree, node, part, x[mine[rows]], ids[mine[rows]])
    return run


def _entries(tree: dict, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the (cls, p) entries of the leaves ``at``, and how many each has."""
    sizes = (tree["stop"] - tree["start"])[at]
    return np.repeat(tree["start"][at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


def _votes(st: Settings):
    """(id, cls, p) of a subtree's vectors: the distribution, or the mean, of the leaf each ends in."""
    def run(key, packets, parts):
        ids, classes, shares = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0)]
        for part in parts.to_pylist():
            tree = {k: np.frombuffer(part[k], PART_FIELDS[k]) for k in PART_FIELDS if k in part}
            for raw, who in zip(packets.column("x").to_pylist(), packets.column("a").to_pylist()):
                at = route(tree, np.frombuffer(raw, _kind(st)).reshape(-1, st.d))
                entry, sizes = _entries(tree, at)
                ids.append(np.repeat(np.frombuffer(who, np.int64), sizes))
                classes.append(tree["cls"][entry])
                shares.append(tree["p"][entry])
        return pa.table({"id": np.concatenate(ids), "cls": np.concatenate(classes), "p": np.concatenate(shares)})
    return run


def predict(fm: ForestModel, df: DataFrame, feature_col: str | None = None) -> DataFrame:
    """``df`` plus ``prediction`` (original label values for classification): the class of the largest sum of the
    trees' leaf distributions (ties to the smallest), or the mean of their means."""
    if fm is None or fm.model is None:
        raise ValueError("the model must be trained before predicting")
    forest, st = fm.model, fm.model.settings
    keyed = _binned(df, feature_col or fm.feature_col, forest.edges, "__cell", False)
    cells = (keyed.select(F.col("__cell").alias("x")).distinct()
             .select("x", F.monotonically_increasing_id().alias("id")))
    cells = write_once(cells, "forest-cells")
    n = cells.count()
    salts = [[max(1, math.ceil(n * s / max(1, sum(x for x, f in zip(top.size, top.feature) if f < 0)) / GROUP_ROWS)) for s in top.size]
             for top in forest.tops]
    table = [(t, node, salt) for t, top in enumerate(forest.tops) for node, f in enumerate(top.feature) if f < 0 for salt in range(salts[t][node])]
    spread = df.sparkSession.createDataFrame(pd.DataFrame(table, columns=["tree", "node", "salt"]), "tree int, node long, salt int")
    parts = forest.parts.drop("importance").join(F.broadcast(spread), ["tree", "node"])
    tasks = _tasks(df.sparkSession, len(table), n * st.trees)
    packets = cells.mapInArrow(_asked([t.arrays() for t in forest.tops], salts, st), PACKET_SCHEMA).repartition(tasks, "tree", "node", "salt")
    parts = parts.repartition(tasks, "tree", "node", "salt")
    votes = (packets.groupBy("tree", "node", "salt").cogroup(parts.groupBy("tree", "node", "salt"))
             .applyInArrow(_votes(st), "id long, cls int, p double"))
    if st.classes:
        votes = votes.groupBy("id", "cls").agg(F.round(F.sum("p"), 9).alias("p"))
        got = votes.groupBy("id").agg(F.min_by("cls", F.struct(-F.col("p"), F.col("cls"))).cast("double").alias("prediction"))
    else:
        got = votes.groupBy("id").agg((F.sum("p") / st.trees).alias("prediction"))
    answers = cells.join(got, "id").select(F.col("x").alias("__cell"), "prediction")
    out = keyed.join(answers, "__cell").drop("__cell")
    if fm.task == "classification":
        out = out.withColumn("prediction", lookup({float(i): c for i, c in enumerate(fm.classes)},
                                                  F.col("prediction")))
    return out.select(*df.columns, "prediction")


def feature_importance(fm: ForestModel, names: list[str]) -> DataFrame:
    """``(feature, importance)`` sorted by importance, descending."""
    spark = _spark()
    imp = fm.model.importances().tolist()
    rows = sorted(zip(names, imp), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def side_by_side(spark: SparkSession, run: Callable, items: list) -> list:
    """``run`` of every item, in their order. Some run at a time, so that the short steps of one forest
    fill the cores that another's leave idle."""
    with ThreadPoolExecutor(max_workers=AT_ONCE) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(run), x) for x in items]]


# ---------------------------------------------------------------- many small forests

SMALL_SCHEMA = "s int, block int, d int, x binary, y binary, test binary"
VOTE_SCHEMA = "s int, classes int, y binary, votes binary"   # classes -1: rows for the other steps


def is_small(rows: int, width: int, held_out: int, classes: int) -> bool:
    """Whether a forest over so many rows is small enough for :func:`score_small`."""
    return rows <= GROUP_ROWS and rows * width * 8 <= SMALL_BYTES and held_out * classes * 8 <= VOTE_BYTES


def _parts(cut: dict, blocks: int):
    """Packets of the rows of every solution, for each block of its trees. ``cut``: the (hash, row id) up to which its rows
    are held out, None: all. Width -1: rows that only the other steps can judge (nulls, arrays of several lengths)."""
    def packet(s: int, block: int, d: int, x: bytes = b"", y: bytes = b"", test: bytes = b"") -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*[pa.array([v], pa.int32()) for v in (s, block, d)], *[pa.array([v], pa.binary()) for v in (x, y, test)]],
            names=["s", "block", "d", "x", "y", "test"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if not rb.num_rows:
                continue
            x = rb.column("x")
            size = np.diff(np.asarray(x.offsets))
            odd = any(c.null_count for c in rb.columns) or x.flatten().null_count or (size != size[:1]).any()
            if not odd:
                h, ids, y = (np.asarray(rb.column(c)) for c in ("h", "row_id", "y"))
                values = np.asarray(x.flatten()).reshape(rb.num_rows, int(size[0]))
                words = {w: np.asarray(rb.column(f"mask_{w}")) for w in {s // WORD_BITS for s in cut}}
            for s, limit in cut.items():
                if odd:
                    yield packet(s, 0, -1)
                    continue
                mine = np.flatnonzero((words[s // WORD_BITS] >> (s % WORD_BITS)) & 1)
                if not len(mine):
                    continue
                test = np.ones(len(mine), bool)
                if limit is not None:
                    test = (h[mine] < limit[0]) | ((h[mine] == limit[0]) & (ids[mine] <= limit[1]))
                blobs = values[mine].tobytes(), y[mine].tobytes(), test.tobytes()
                for block in range(blocks):
                    yield packet(s, block, values.shape[1], *blobs)
    return run


def _same_rows(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The rows of bins and class as values that compare."""
    both = np.concatenate([x.view(np.uint8).reshape(len(x), -1), np.ascontiguousarray(y.astype("<i4")).view(np.uint8).reshape(-1, 4)], axis=1)
    return np.ascontiguousarray(both).view(f"V{both.shape[1]}")[:, 0]


def _small_trees(x: np.ndarray, y: np.ndarray, st: Settings, trees: range) -> Iterator[tuple[dict, int]]:
    """(trees grown together, their number) over these binned rows."""
    _, first, copies = np.unique(_same_rows(x, y), return_index=True, return_counts=True)
    x, y = x[first], y[first]
    h = xxhash64_rows(x.view(np.uint8).reshape(len(x), -1), y)
    draws, most = [], min(DRAWN_ROWS, SMALL_BYTES // (8 * st.d))
    for i, tree in enumerate(trees):
        w = bootstrap(h, copies, tree, st.seed) if st.trees > 1 else copies
        if len(row := np.flatnonzero(w)):
            draws.append((tree, row, w[row]))
        if draws and (i + 1 == len(trees) or sum(len(r) for _, r, _ in draws) >= most):
            yield grow(x, y, np.concatenate([w for _, _, w in draws]), None, classes=st.classes, bins=st.bins, s=st.s, depth=0,
                       max_depth=st.max_depth, rng=[np.random.default_rng([st.seed, t, 0]) for t, _, _ in draws],
                       row=np.concatenate([r for _, r, _ in draws]), root=np.repeat(np.arange(len(draws)), [len(r) for _, r, _ in draws])), len(draws)
            draws = []


def _small_votes(kind, num_trees: int, max_depth: int, max_bins: int, seed: int, blocks: int):
    """Grows a block of the trees of a forest, and sums up their votes on the rows held out."""
    def run(key, packets):
        s, block = key[0].as_py(), key[1].as_py()

        def out(classes: int, y: bytes = b"", votes: bytes = b"") -> pa.Table:
            return pa.table({"s": pa.array([s], pa.int32()), "classes": pa.array([classes], pa.int32()), "y": pa.array([y], pa.binary()),
                             "votes": pa.array([votes], pa.binary())})

        widths = set(packets.column("d").to_pylist())
        if len(widths) > 1 or -1 in widths or 0 in widths:
            return out(-1)
        d, labels, test = widths.pop(), _joined(packets, "y", np.int64), _joined(packets, "test", bool)
        values = _joined(packets, "x", kind).reshape(-1, d).astype(np.float64)
        known = np.unique(labels[~test])
        if len(known) < 2:
            return out(len(known))
        n = int((~test).sum())
        edges = [split_points(np.ascontiguousarray(values[~test, j]), min(max_bins, n)) for j in range(d)]
        x = np.empty(values.shape, np.uint8 if max(map(len, edges)) < 256 else np.uint16)
        for j, e in enumerate(edges):
            x[:, j] = np.searchsorted(e, values[:, j], side="left")
        y = np.searchsorted(known, labels)
        y[~np.isin(labels, known)] = -1
        st = Settings(len(known), d, max(map(len, edges)) + 1, math.ceil(math.sqrt(d)) if num_trees > 1 else d, num_trees, seed, max_depth)
        order = np.argsort(_same_rows(x[test], y[test]))       # whatever the order of arrival
        asked, truth = x[test][order], y[test][order]
        votes = np.zeros(len(asked) * st.classes)
        for tree, roots in _small_trees(x[~test], y[~test], st, range(block * num_trees // blocks, (block + 1) * num_trees // blocks)):
            for at in route(tree, asked, roots).reshape(roots, -1):
                entry, sizes = _entries(tree, at)
                votes += np.bincount(np.repeat(np.arange(len(asked)), sizes) * st.classes + tree["cls"][entry], tree["p"][entry], len(votes))
        return out(st.classes, truth.astype(np.int32).tobytes(), votes.tobytes())
    return run


def _right(key, blocks):
    """(solution, classes, held-out rows, those that the votes of all blocks get right)"""
    classes = min(blocks.column("classes").to_pylist())
    held = right = 0
    if classes > 1:
        truth = np.frombuffer(blocks.column("y")[0].as_py(), np.int32)
        votes = np.zeros((len(truth), classes))
        for raw in sorted(blocks.column("votes").to_pylist()):
            votes += np.frombuffer(raw, np.float64).reshape(votes.shape)
        votes, held = np.round(votes, 9), len(truth)
        right = int(((votes.argmax(axis=1) == truth) & (votes.max(axis=1) > 0)).sum())
    return pa.table({"s": pa.array([key[0].as_py()], pa.int32()), "classes": pa.array([classes], pa.int32()), "held": pa.array([held], pa.int64()),
                     "correct": pa.array([right], pa.int64())})


def score_small(table: DataFrame, cut: dict, h, *, num_trees: int, max_depth: int, seed: int, feature_col: str,
                max_bins: int = 32) -> dict[int, float | None]:
    """Of every solution in ``cut`` (small ones, see :func:`is_small`; {solution: (h, row id) up to which its rows are held
    out}) the accuracy on the held-out rows of a forest on its other rows; None: a forest refuses these rows (one class).
    Bins are quantiles of all rows. Solutions that need :func:`fit_forest` are left out."""
    kinds = {T.FloatType(): np.float32, T.DoubleType(): np.float64}
    kind = table.schema[feature_col].dataType
    if not cut or not isinstance(kind, T.ArrayType) or kind.elementType not in kinds or not isinstance(table.schema["label"].dataType, T.IntegralType):
        return {}
    spark = table.sparkSession
    blocks = min(-(-num_trees // LEAST_TREES), -(-4 * spark.sparkContext.defaultParallelism // len(cut)))
    rows = table.select("row_id", h.alias("h"), F.col("label").cast("long").alias("y"), F.col(feature_col).alias("x"),
                        *[f"mask_{w}" for w in sorted({s // WORD_BITS for s in cut})])
    groups = len(cut) * blocks
    votes = (rows.mapInArrow(_parts(cut, blocks), SMALL_SCHEMA).repartition(2 * groups, "s", "block").groupBy("s", "block")
             .applyInArrow(_small_votes(kinds[kind.elementType], num_trees, min(max_depth, MAX_SPARK_DEPTH), max_bins, seed, blocks), VOTE_SCHEMA))
    found = votes.groupBy("s").applyInArrow(_right, "s int, classes int, held long, correct long").collect()
    return {r["s"]: r["correct"] / max(1, r["held"]) if r["classes"] > 1 else None for r in found if r["classes"] >= 0}


def cross_validate(df: DataFrame, *, task: str = "classification", k: int = 5,
                   **forest_kw) -> DataFrame:
    """Per-fold scores (accuracy, or negative MSE for regression) of forests
    fitted on the other folds; unshuffled folds, stratified for classification."""
    from .split import kfolds, stratified_folds
    if task == "classification":
        folded = stratified_folds(df, k)
    else:
        folded = kfolds(df, df.count(), k)
    folded = folded.persist()
    classes = (sorted(r[0] for r in df.select("label").distinct().collect())
               if task == "classification" else None)

    def scored(f: int) -> tuple[int, float]:
        fm = fit_forest(folded.where(F.col("fold") != f), task=task, classes=classes, **forest_kw)
        try:
            pred = predict(fm, folded.where(F.col("fold") == f))
            if task == "classification":
                return f, float(metrics.accuracy(pred, "label", "prediction").first()[0])
            return f, float(-metrics.mse(pred, "label", "prediction").first()[0])
        finally:
            fm.release()

    try:
        scores = side_by_side(df.sparkSession, scored, list(range(k)))
    finally:
        folded.unpersist()
    return df.sparkSession.createDataFrame(scores, "fold int, score double")


def evaluate(fm: ForestModel, test: DataFrame, full: DataFrame | None = None,
             **cv_kw) -> tuple[DataFrame, DataFrame]:
    """Tidy metric table ``(metric, class, value)`` and the predictions:
    training time and start, optional cross-validation mean/std over ``full`` (forests
    with the fitted one's settings unless others are given),
    then accuracy + report (classification) or mse + r2 (regression)."""
    spark = _spark()
    pred = predict(fm, test).persist()
    rows = [("training_time", None, float(fm.training_time)),
            ("timestamp", None, float(fm.timestamp.timestamp()))]
    if full is not None:
        sc = metrics.mean_std(cross_validate(full, task=fm.task, **((fm.settings or {}) | cv_kw)), "score").first()
        rows += [("cv_scores_mean", None, sc["mean"]), ("cv_scores_std", None, sc["std"])]
    if fm.task == "classification":
        rows.append(("accuracy", None, metrics.accuracy(pred).first()[0]))
        for r in metrics.classification_report(pred).collect():
            for m in ("precision", "recall", "f1"):
                rows.append((m, r["class"], r[m]))
            rows.append(("support", r["class"], float(r["support"])))
    else:
        rows.append(("mse", None, metrics.mse(pred).first()[0]))
        rows.append(("r2", None, metrics.r2(pred).first()[0]))
    return spark.createDataFrame(rows, "metric string, class string, value double"), pred
