"""A hot key holding a third of the rows must not change results (and is
never gathered into one window group)."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowsift.operators import ranks, split
from rowsift.operators.order_stats import smallest_k_cutoffs, within_cutoff


def skewed(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    vals = [7 if i % 3 == 0 else int(rng.integers(0, 500)) for i in range(n)]
    return spark.createDataFrame([(i, v, v % 4 if v != 7 else 7) for i, v in enumerate(vals)],
                                 "row_id long, value long, label long")


def test_rank_positions_hot_value(spark):
    df = skewed(spark)
    got = {r.row_id: r.position for r in ranks.rank_positions(df, "value").collect()}
    vals = {r.row_id: r.value for r in df.collect()}
    srt = sorted(vals.values())
    first = {}
    for i, v in enumerate(srt):
        first.setdefault(v, i)
    assert all(got[i] == first[v] for i, v in vals.items())


def test_stratified_folds_hot_class(spark):
    df = skewed(spark).select("row_id", "label")
    got = split.stratified_folds(df, 5)
    sizes = {r.fold: r["count"] for r in got.groupBy("fold").count().collect()}
    assert sum(sizes.values()) == 3000 and max(sizes.values()) - min(sizes.values()) <= 5
    # brute force of the rule: classes in order of first appearance, sorted
    # class codes dealt round-robin to the folds, rows in order within a class
    rows = sorted((r.row_id, r.label) for r in df.collect())
    order = []
    for _, lab in rows:
        if lab not in order:
            order.append(lab)
    code = {lab: i for i, lab in enumerate(order)}
    sorted_codes = sorted(code[lab] for _, lab in rows)
    alloc = {c: [0] * 5 for c in code.values()}
    for j, c in enumerate(sorted_codes):
        alloc[c][j % 5] += 1
    seen = {c: 0 for c in code.values()}
    exp = {}
    for rid, lab in rows:
        c = code[lab]
        r, f, run = seen[c], 0, alloc[c][0]
        while r >= run:
            f += 1
            run += alloc[c][f]
        exp[rid] = f
        seen[c] += 1
    assert {r.row_id: r.fold for r in got.collect()} == exp


def test_cutoffs_hot_group_multilevel(spark):
    rng = np.random.default_rng(2)
    rows = [(0 if i % 3 == 0 else int(rng.integers(1, 6)), int(rng.integers(0, 1 << 60)), i)
            for i in range(6000)]
    df = spark.createDataFrame(rows, "grp long, h long, row_id long")
    k = {0: 1500, 1: 3, 2: 400, 3: 0}
    cut = smallest_k_cutoffs(df, k, bits_per_level=3, collect_limit=40)
    got = {(r.grp, r.row_id) for r in df.where(within_cutoff(cut)).collect()}
    w = Window.partitionBy("grp").orderBy("h", "row_id")
    exp = {(r.grp, r.row_id) for r in df.withColumn("rn", F.row_number().over(w)).collect()
           if r.rn <= k.get(r.grp, 0)}
    assert got == exp
