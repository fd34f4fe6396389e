"""k-nearest-neighbour classification of many candidate subsets in one pass.

Training samples are bounded (at most ``train_cap`` rows per solution), so the
stacked sample of all solutions has a proven size bound of
``P * train_cap * d * 8`` bytes; it is broadcast when that bound fits the
budget, otherwise the solutions are split into groups that fit and evaluated
in several passes (same result). Query rows never leave their partition: one
``mapInArrow`` pass (feature lists reshaped from the Arrow buffer, no Python
object per row) emits ``(solution, correct, total)`` per batch and a tiny
aggregate sums them.

Neighbour order is (Euclidean distance, training row id); the vote picks the
most frequent label, ties to the smallest label. Distances are first ranked by
a BLAS product of float32, then the best ``k + margin`` candidates are re-measured exactly;
a row whose k-th exact distance is not clearly (by more than the rounding) below the best
excluded candidate is ranked by doubles, and if need be re-measured against the whole sample,
so the result is exact.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bits import WORD_BITS
from ..session import write_once

EVAL_SCHEMA = "solution int, correct long, total long"
CHUNK_CELLS = 256_000      # distances ranked at once: 1 MB, which stays in a core's cache


@dataclass
class KnnSample:
    """Training sample of each solution (driver side, bounded)."""
    classes: np.ndarray                      # sorted distinct labels
    feats: dict = field(default_factory=dict)   # s -> (t, d) float64
    ids: dict = field(default_factory=dict)     # s -> (t,) int64 row ids
    labels: dict = field(default_factory=dict)  # s -> (t,) class index

    def nbytes(self, solutions=None) -> int:
        sols = self.feats if solutions is None else solutions
        return sum(self.feats[s].nbytes + self.ids[s].nbytes * 2 for s in sols)


def neighbours(xq: np.ndarray, xt: np.ndarray, tid: np.ndarray, k: int,
               margin: int = 5, ready: tuple | None = None) -> np.ndarray:
    """Indices (into xt) of the k nearest training rows of every query row. ``ready``: what
    :func:`prepared` made of ``xt``, for callers that ask in chunks."""
    t, d = xt.shape
    k = min(k, t)
    kk = k + margin
    if kk >= t or not len(xq):
        return _neighbours_double(xq, xt, tid, k, margin)
    middle, wide, most = prepared(xt) if ready is None else ready
    with np.errstate(over="ignore", invalid="ignore"):
        q = np.ones((len(xq), d + 1), np.float32)
        q[:, :-1] = xq - middle
        sq_q = np.einsum("ij,ij->i", q, q, dtype=np.float64) - 1
        approx = q @ wide
        # of the minima of many small groups of rows, the (kk + 1)-th is no less than that of all rows
        groups = -(-t // 8) if t >= 32 * kk else t
        least = _minima(approx, groups)
        boundary = np.partition(least, kk, axis=1)[:, kk]
        # (float32 squares and products of d values, each off by at most d roundings)
        tol = (d + 8) * 2.0**-22 * (sq_q + most)
        sure = np.isfinite(boundary) & np.isfinite(tol)
        inside = approx <= np.where(sure, boundary, -np.inf).astype(np.float32)[:, None]
    count = np.count_nonzero(inside, axis=1)
    sure &= count <= 4 * kk
    inside[~sure] = False
    count[~sure] = 0
    top = np.zeros((len(xq), k), np.int64)
    at = np.flatnonzero(sure)
    if len(at):
        who, cand = np.divmod(np.flatnonzero(inside), t)
        diff = np.take(xt, cand, axis=0)
        diff -= np.take(xq, who, axis=0)
        exact = np.einsum("ij,ij->i", diff, diff)
        order = np.lexsort((tid[cand], exact, who))
        picked = order[(np.cumsum(count) - count)[at, None] + np.arange(k)]
        top[at] = cand[picked]
        sure[at] = exact[picked[:, -1]] < sq_q[at] + boundary[at] - tol[at]
    again = np.flatnonzero(~sure)
    if len(again):                      # not told apart by float32
        top[again] = _neighbours_double(xq[again], xt, tid, k, margin)
    return top


def _minima(approx: np.ndarray, groups: int) -> np.ndarray:
    """Minimum of every ``groups``-th column, for each of the first ``groups`` columns."""
    least = approx[:, :groups].copy()
    for lo in range(groups, approx.shape[1], groups):
        part = approx[:, lo:lo + groups]
        np.minimum(least[:, :part.shape[1]], part, out=least[:, :part.shape[1]])
    return least


def prepared(xt: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(middle, float32 columns (-2 * t, t * t) of the centred rows t, largest t * t): the product of (query, 1) with
    them ranks the rows."""
    middle = xt.mean(axis=0)
    with np.errstate(over="ignore", invalid="ignore"):
        centred = (xt - middle).astype(np.float32)
        squares = np.einsum("ij,ij->i", centred, centred, dtype=np.float64)
        return middle, np.ascontiguousarray(np.column_stack([-2 * centred, squares.astype(np.float32)]).T), float(squares.max())


def _neighbours_double(xq: np.ndarray, xt: np.ndarray, tid: np.ndarray, k: int, margin: int) -> np.ndarray:
    """The same, ranked by products of doubles, and where these do not tell rows apart by all exact distances."""
    t = xt.shape[0]
    k = min(k, t)
    sq_q = np.einsum("ij,ij->i", xq, xq)
    sq_t = np.einsum("ij,ij->i", xt, xt)
    approx = sq_q[:, None] + sq_t[None, :] - 2.0 * (xq @ xt.T)
    kk = min(t, k + margin)
    if kk < t:
        part = np.argpartition(approx, kk, axis=1)
        cand = part[:, :kk]
        boundary = approx[np.arange(len(xq))[:, None], part[:, kk:kk + 1]][:, 0]
    else:
        cand = np.broadcast_to(np.arange(t), (len(xq), t))
        boundary = np.full(len(xq), np.inf)
    diff = xq[:, None, :] - xt[cand]
    exact = np.einsum("ijk,ijk->ij", diff, diff)
    order = np.lexsort((tid[cand], exact), axis=1)[:, :k]
    rows = np.arange(len(xq))[:, None]
    top = cand[rows, order]
    kth = exact[rows, order][:, -1]
    tol = 1e-9 * (sq_q + sq_t.max() + 1.0)
    redo = np.nonzero(kth >= boundary - tol)[0]
    for r in redo:                      # rare: re-measure this row exactly
        d = xq[r] - xt
        ex = np.einsum("jk,jk->j", d, d)
        top[r] = np.lexsort((tid, ex))[:k]
    return top


def vote(nbr_labels: np.ndarray) -> np.ndarray:
    """Majority class index per row; ties go to the smallest class index."""
    votes = (nbr_labels[:, :, None] == nbr_labels[:, None, :]).sum(axis=2)
    most = votes == votes.max(axis=1, keepdims=True)
    return np.where(most, nbr_labels, np.iinfo(np.int64).max).min(axis=1)


def arrow_matrix(arr) -> np.ndarray:
    """(rows, d) float64 matrix of an Arrow list column, without a Python
    object per row when all lists have the same length (the common case)."""
    import pyarrow as pa
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0))
    offsets = np.asarray(arr.offsets)
    lengths = np.diff(offsets)
    if arr.null_count == 0 and (lengths == lengths[0]).all():
        flat = np.asarray(arr.values)[offsets[0]:offsets[-1]]
        return flat.astype(np.float64).reshape(n, int(lengths[0]))
    return np.vstack([np.asarray(x, dtype=np.float64) for x in arr.to_pylist()])


def _eval_fn(bc, solutions: list[int], feature_col: str, k: int, chunk_rows: int):
    import pyarrow as pa

    def run(batches):
        smp: KnnSample = bc.value
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x_all = arrow_matrix(rb.column(feature_col))
            lab = np.asarray(rb.column("label"))
            words = {}
            out_s, out_c, out_t = [], [], []
            for s in solutions:
                w, b = divmod(s, WORD_BITS)
                if w not in words:
                    words[w] = np.asarray(rb.column(f"mask_{w}"))
                sel = np.nonzero((words[w] >> b) & 1)[0]
                if len(sel) == 0:
                    continue
                xt, tid, tlab = smp.feats[s], smp.ids[s], smp.labels[s]
                ready, correct = prepared(xt), 0
                for lo in range(0, len(sel), chunk_rows):
                    part = sel[lo:lo + chunk_rows]
                    top = neighbours(x_all[part], xt, tid, k, ready=ready)
                    pred = smp.classes[vote(tlab[top])]
                    correct += int((pred == lab[part]).sum())
                out_s.append(s)
                out_c.append(correct)
                out_t.append(len(sel))
            if out_s:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_s, pa.int32()), pa.array(out_c, pa.int64()),
                     pa.array(out_t, pa.int64())], names=["solution", "correct", "total"])
    return run


def evaluate_population(table: DataFrame, sample: KnnSample, solutions: list[int], *,
                        feature_col: str = "features", k: int = 5,
                        broadcast_budget: int = 512 << 20) -> dict[int, tuple[int, int]]:
    """``{solution: (correct, total)}`` of k-NN trained on each solution's sample,
    predicting every row the solution keeps."""
    spark = table.sparkSession
    sc = spark.sparkContext
    groups, cur, size = [], [], 0
    for s in solutions:
        b = sample.nbytes([s])
        if cur and size + b > broadcast_budget:
            groups.append(cur)
            cur, size = [], 0
        cur.append(s)
        size += b
    if cur:
        groups.append(cur)
    mask_cols = sorted({f"mask_{s // WORD_BITS}" for s in solutions})
    narrow = table.select("label", feature_col, *mask_cols)
    result: dict[int, tuple[int, int]] = {}
    for grp in groups:
        part = KnnSample(sample.classes, {s: sample.feats[s] for s in grp},
                         {s: sample.ids[s] for s in grp}, {s: sample.labels[s] for s in grp})
        bc = sc.broadcast(part)
        try:
            t = max(1, max(len(v) for v in part.ids.values()))
            chunk = int(max(16, min(4096, CHUNK_CELLS // t)))
            rows = (narrow.mapInArrow(_eval_fn(bc, grp, feature_col, k, chunk), EVAL_SCHEMA)
                    .groupBy("solution")
                    .agg(F.sum("correct").alias("correct"), F.sum("total").alias("total"))
                    .collect())
        finally:
            bc.unpersist()
        for r in rows:
            result[r["solution"]] = (int(r["correct"]), int(r["total"]))
    return result


def collect_train(train: DataFrame, *, feature_col: str = "features", id_col: str = "row_id",
                  label_col: str = "label", classes: list | None = None,
                  budget: int = 512 << 20) -> KnnSample:
    """Fetch a bounded training set (size checked before it is fetched)."""
    n, d = _matrix_size(train, feature_col)
    if n == 0:
        raise ValueError("empty training set")
    if n * d * 8 > budget:
        raise ValueError(f"training set of {n} rows x {d} exceeds the broadcast budget")
    pdf = train.select(id_col, label_col, feature_col).toPandas().sort_values(id_col)
    labels = pdf[label_col].tolist()
    cls = np.array(sorted(classes if classes is not None else set(labels)))
    pos = {c: i for i, c in enumerate(cls.tolist())}
    smp = KnnSample(cls)
    smp.feats[0] = np.vstack(pdf[feature_col].to_numpy()).astype(np.float64)
    smp.ids[0] = pdf[id_col].to_numpy(dtype=np.int64)
    smp.labels[0] = np.asarray([pos[x] for x in labels], dtype=np.int64)
    return smp


ARROW_TYPES = {"int": "int32", "integer": "int32", "long": "int64", "bigint": "int64",
               "double": "float64", "float": "float32", "string": "string"}


def _predict_fn(bc, feature_col, id_col, k, chunk, neighbours_out, label_type="int", keep=()):
    import pyarrow as pa
    out_type = pa.type_for_alias(ARROW_TYPES.get(label_type, label_type))

    def run(batches):
        smp: KnnSample = bc.value
        xt, tid, tlab = smp.feats[0], smp.ids[0], smp.labels[0]
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = arrow_matrix(rb.column(feature_col))
            ids = np.asarray(rb.column(id_col))
            for lo in range(0, rb.num_rows, chunk):
                xq = x[lo:lo + chunk]
                top = neighbours(xq, xt, tid, k)
                if neighbours_out:
                    diff = xq[:, None, :] - xt[top]
                    dist = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
                    kk = top.shape[1]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.repeat(ids[lo:lo + chunk], kk), pa.int64()),
                        pa.array(np.tile(np.arange(1, kk + 1, dtype=np.int32), len(xq))),
                        pa.array(tid[top].ravel(), pa.int64()),
                        pa.array(dist.ravel(), pa.float64())],
                        names=[id_col, "rank", "train_id", "distance"])
                else:
                    pred = smp.classes[vote(tlab[top])]
                    extra = [rb.column(c).slice(lo, len(xq)) for c in keep]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[lo:lo + chunk], pa.int64()), *extra,
                         pa.array(pred.tolist(), out_type)],
                        names=[id_col, *keep, "prediction"])
    return run


def knn_predict(table: DataFrame, sample: KnnSample, *, k: int = 5, feature_col: str = "features",
                id_col: str = "row_id", label_type: str = "int", keep: tuple = ()) -> DataFrame:
    """``(id, *keep, prediction)`` for every row of ``table``; ``keep`` columns
    travel with the batches (no join back)."""
    bc = table.sparkSession.sparkContext.broadcast(sample)
    fields = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    schema = ", ".join([f"{id_col} long"] + [f"`{c}` {fields[c]}" for c in keep] +
                       [f"prediction {label_type}"])
    return table.select(id_col, *keep, feature_col).mapInArrow(
        _predict_fn(bc, feature_col, id_col, k, 2048, False, label_type, tuple(keep)), schema)


def knn_neighbours(table: DataFrame, sample: KnnSample, *, k: int = 5,
                   feature_col: str = "features", id_col: str = "row_id") -> DataFrame:
    """``(id, rank, train_id, distance)``: the k nearest training rows per row."""
    bc = table.sparkSession.sparkContext.broadcast(sample)
    schema = f"{id_col} long, rank int, train_id long, distance double"
    return table.select(id_col, feature_col).mapInArrow(
        _predict_fn(bc, feature_col, id_col, k, 2048, True), schema)


def _candidates_fn(bc, feature_col, id_col, k, chunk, label_type="int"):
    import pyarrow as pa
    out_type = pa.type_for_alias(ARROW_TYPES.get(label_type, label_type))

    def run(batches):
        smp: KnnSample = bc.value
        xt, tid, tlab = smp.feats[0], smp.ids[0], smp.labels[0]
        for rb in batches:
            if rb.num_rows == 0:
                continue
            x = arrow_matrix(rb.column(feature_col))
            ids = np.asarray(rb.column(id_col))
            for lo in range(0, rb.num_rows, chunk):
                xq = x[lo:lo + chunk]
                top = neighbours(xq, xt, tid, k)
                diff = xq[:, None, :] - xt[top]
                d2 = np.einsum("ijk,ijk->ij", diff, diff)
                kk = top.shape[1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids[lo:lo + chunk], kk), pa.int64()),
                    pa.array(tid[top].ravel(), pa.int64()),
                    pa.array(d2.ravel(), pa.float64()),
                    pa.array(smp.classes[tlab[top]].ravel().tolist(), out_type)],
                    names=[id_col, "train_id", "d2", "train_label"])
    return run


def knn_topk(table: DataFrame, train: DataFrame, *, k: int = 5, feature_col: str = "features",
             id_col: str = "row_id", label_col: str = "label", label_type: str = "int",
             budget: int = 512 << 20) -> DataFrame:
    """``(id, rank, train_id, distance, train_label)``: the k nearest training
    rows of every row of ``table``, for a training set of any size.

    The training set is cut into blocks whose matrix fits ``budget`` and written; one block at a time
    is fetched and broadcast, its k candidates per row are merged with the k nearest so far (at most
    2 * k rows per query id), and that state is written before the block's broadcast is
    destroyed. So neither the driver nor an executor ever holds more than one block.
    """
    n, d = _matrix_size(train, feature_col)
    if n == 0:
        raise ValueError("empty training set")
    per_chunk = max(k, budget // (d * 8 + 16))
    chunks = -(-n // per_chunk)
    if chunks > 1:
        from .rowid import ordered_positions
        keyed = ordered_positions(train.select(id_col, label_col, feature_col), [id_col],
                                  out_col="__pos")
        keyed = write_once(keyed.withColumn("__chunk", F.floor(F.col("__pos") / F.lit(per_chunk))), "training-blocks")
    else:
        keyed = train.select(id_col, label_col, feature_col, F.lit(0).alias("__chunk"))
    classes = sorted(r[0] for r in keyed.select(label_col).distinct().collect())
    schema = f"{id_col} long, train_id long, d2 double, train_label {label_type}"
    w = Window.partitionBy(id_col).orderBy("d2", "train_id")
    best = None
    for c in range(chunks):
        smp = collect_train(keyed.where(F.col("__chunk") == c), feature_col=feature_col,
                            id_col=id_col, label_col=label_col, classes=classes, budget=budget)
        bc = table.sparkSession.sparkContext.broadcast(smp)
        new = table.select(id_col, feature_col).mapInArrow(
            _candidates_fn(bc, feature_col, id_col, k, 2048, label_type), schema)
        both = new if best is None else best.unionByName(new)
        best = write_once(both.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("rank"), "nearest")
        bc.destroy()
    cand = best.withColumn("rank", F.row_number().over(w))
    return cand.select(id_col, F.col("rank").cast("int").alias("rank"), "train_id",
                       F.sqrt("d2").alias("distance"), "train_label")


def vote_predictions(cand: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Majority label of each id's neighbours, ties to the smallest label."""
    votes = cand.groupBy(id_col, "train_label").agg(F.count(F.lit(1)).alias("votes"))
    return votes.groupBy(id_col).agg(
        F.min_by("train_label", F.struct(-F.col("votes"), F.col("train_label")))
        .alias("prediction"))


def _matrix_size(train: DataFrame, feature_col: str) -> tuple[int, int]:
    """Rows and longest feature array of a training set."""
    size = train.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(feature_col)).alias("d")).first()
    return size["n"], max(size["d"] or 1, 1)


def _fits(train: DataFrame, feature_col: str, budget: int) -> bool:
    n, d = _matrix_size(train, feature_col)
    return n * d * 8 <= budget


def knn_classify(table: DataFrame, train: DataFrame, *, k: int = 5, feature_col: str = "features",
                 id_col: str = "row_id", label_type: str = "int", keep: tuple = (),
                 budget: int = 512 << 20) -> DataFrame:
    """``(id, prediction)`` of k-NN trained on ``train``: one broadcast pass when
    the training matrix fits ``budget`` (size checked first), else the chunked
    exact path of :func:`knn_topk`."""
    if _fits(train, feature_col, budget):
        return knn_predict(table, collect_train(train, feature_col=feature_col, id_col=id_col,
                                                budget=budget),
                           k=k, feature_col=feature_col, id_col=id_col, label_type=label_type,
                           keep=keep)
    cand = knn_topk(table, train, k=k, feature_col=feature_col, id_col=id_col,
                    label_type=label_type, budget=budget)
    pred = vote_predictions(cand, id_col)
    return table.select(id_col, *keep).join(pred, id_col) if keep else pred


def knn_rank(table: DataFrame, train: DataFrame, *, k: int = 5, feature_col: str = "features",
             id_col: str = "row_id", budget: int = 512 << 20) -> DataFrame:
    """``(id, rank, train_id, distance)`` of the k nearest training rows."""
    if _fits(train, feature_col, budget):
        return knn_neighbours(table, collect_train(train, feature_col=feature_col, id_col=id_col,
                                                   budget=budget),
                              k=k, feature_col=feature_col, id_col=id_col)
    return knn_topk(table, train, k=k, feature_col=feature_col, id_col=id_col,
                    budget=budget).drop("train_label")
