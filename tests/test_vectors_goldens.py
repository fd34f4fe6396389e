"""Index-vector operators against the reference programs' saved outputs."""

from pyspark.sql import functions as F

from rowsift.functions import formats
from rowsift.operators import partitions, previews, ranks, reductions, vectors


def idx(spark, n):
    return vectors.gen_index(spark, n)


def test_filter_even_20(spark):
    got = sorted(r.idx for r in vectors.filter_even(idx(spark, 20)).collect())
    assert got == list(range(0, 20, 2))


def test_const_plus_index_rows_of_10(spark):
    df = idx(spark, 100).select("idx", vectors.const(100).alias("value"))
    df = df.select("idx", vectors.add_index("value").alias("value"))
    lines = {r.line: r.text for r in formats.rows_of(df, 10).collect()}
    assert lines[0] == " ".join(str(100 + i) for i in range(10))
    assert lines[9] == " ".join(str(190 + i) for i in range(10))
    chk = reductions.verify_expected(df, F.lit(100) + F.col("idx")).first()
    assert chk.n_mismatch == 0 and chk.first_idx is None


def test_desc_plus_asc_all_equal(spark):
    n = 1000
    df = idx(spark, n).select("idx", vectors.add(vectors.ramp_desc(n), vectors.ramp()).alias("value"))
    r = reductions.all_equal(df).first()
    assert r.all_equal and r.first_value == 999


def test_ten_times_equation(spark):
    df = idx(spark, 70).select("idx", formats.format_equation(
        F.lit(10), F.col("idx"), vectors.mul(F.lit(10), F.col("idx"))).alias("t"))
    got = {r.idx: r.t for r in df.collect()}
    assert got[0] == "10 * 0 = 0" and got[69] == "10 * 69 = 690"


def test_squares(spark):
    df = idx(spark, 1000).select("idx", vectors.square("idx").alias("value"))
    assert reductions.verify_expected(df, F.col("idx") * F.col("idx")).first().n_mismatch == 0


def test_lincomb2_covered(spark):
    i = F.col("idx")
    v = vectors.covered(vectors.lincomb2(F.lit(2) * i, F.lit(3) * i, 2, 3), 128)
    got = {r.idx: r.v for r in idx(spark, 500).select("idx", v.alias("v")).collect()}
    assert got[127] == 1651 and got[128] == 0 and got[0] == 0 and got[499] == 0
    full = vectors.covered(vectors.lincomb2(F.lit(2) * i, F.lit(3) * i, 2, 3), 500)
    assert all(r.v == 13 * r.idx for r in idx(spark, 500).select("idx", full.alias("v")).collect())


def test_sum_beyond_32_bits(spark):
    n = 100000
    df = idx(spark, n).select("idx", F.col("idx").alias("value"))
    assert reductions.sum_total(df).first().total == 4999950000


def test_parity_power(spark):
    df = idx(spark, 4000).select("idx", vectors.parity_power(F.lit(3.0)).alias("value"))
    exp = F.when(F.col("idx") % 2 == 0, F.lit(9.0)).otherwise(F.lit(27.0))
    assert reductions.verify_expected(df, exp, eps=1e-5).first().n_mismatch == 0
    df = idx(spark, 4000).select("idx", vectors.parity_power(F.lit(81).cast("bigint")).alias("value"))
    got = {r.idx: r.value for r in previews.head_k(df, 2).collect()}
    assert got == {0: 6561, 1: 531441}


def test_lincomb3(spark):
    a, b, c = vectors.affine(0.0, 0.1), vectors.affine(1.0, 0.2), vectors.affine(0.5, 0.15)
    df = idx(spark, 5000).select("idx", vectors.lincomb3(a, b, c, 2.5, 1.5).alias("value"))
    exp = F.lit(0.775) * F.col("idx") + F.lit(2.25)
    assert reductions.verify_expected(df, exp, eps=1e-6).first().n_mismatch == 0
    a, b, c = vectors.affine(1, 1), vectors.affine(2, 2), vectors.affine(3, 3)
    df = idx(spark, 5000).select("idx", vectors.lincomb3(a, b, c, 1, 2).alias("value"))
    assert reductions.verify_expected(df, F.lit(11) + F.lit(11) * F.col("idx")).first().n_mismatch == 0
    sample = reductions.residual_sample(df, F.lit(11) + F.lit(11) * F.col("idx"), 1000).collect()
    assert len(sample) == 5 and all(r.abs_diff == 0 for r in sample)


def test_scaled_expr_data_and_task_parallel_agree(spark):
    base = idx(spark, 300).select("idx", (F.col("idx") * 1.5).alias("x"),
                                  (F.col("idx") + 2).alias("y"), (F.col("idx") - 7).alias("z"))
    data = base.select("idx", vectors.scaled_expr("x", "y", "z", 4, 2, 3, 0.5).alias("v"))
    tasks = vectors.scaled_expr_tasks(base.select("idx", F.col("x").alias("value")),
                                      base.select("idx", F.col("y").alias("value")),
                                      base.select("idx", F.col("z").alias("value")), 4, 2, 3, 0.5)
    assert sorted(data.collect()) == sorted(tasks.collect())


def test_rank_sort_desc16_and_ties(spark):
    df = idx(spark, 16).select("idx", (F.lit(15) - F.col("idx")).alias("value"))
    pos = {r.value: r.position for r in ranks.rank_positions(df).collect()}
    assert all(pos[v] == v for v in range(16))
    srt = [r.value for r in ranks.rank_sort(df).orderBy("position").collect()]
    assert srt == list(range(16))
    assert ranks.is_sorted(ranks.rank_sort(df).select(F.col("position").alias("idx"), "value")
                           ).first().is_sorted
    assert not ranks.is_sorted(df).first().is_sorted
    ties = spark.createDataFrame([(i, v) for i, v in enumerate([3, 1, 3, 2, 1])], "idx long, value long")
    got = {r.idx: r.position for r in ranks.rank_positions(ties).collect()}
    assert [got[i] for i in range(5)] == [3, 0, 3, 2, 0]
    sc = {r.slot: r.value for r in ranks.scatter_by_position(ties, 5).collect()}
    assert [sc[i] for i in range(5)] == [1, 0, 2, 3, 0]


def test_const_sum(spark):
    n = 1 << 16
    df = idx(spark, n).select("idx", vectors.add(vectors.const(3.0), vectors.const(4.0)).alias("value"))
    r = reductions.all_equal_target(df, 7.0).first()
    assert r.n_failed == 0


def test_chunks_and_blocks(spark):
    ch = idx(spark, 20).select(partitions.chunk_assign("idx", 20, 8).alias("c")).groupBy("c").count()
    sizes = [r["count"] for r in ch.orderBy("c").collect()]
    assert sizes == [3, 3, 3, 3, 2, 2, 2, 2]
    bl = idx(spark, 10).select(partitions.block_partition("idx", 10, 3).alias("b")).collect()
    assert [r.b for r in bl] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_previews(spark):
    df = idx(spark, 5000).select("idx", F.col("idx").alias("value"))
    assert [r.idx for r in previews.tail_k(df, 5).collect()] == [4999, 4998, 4997, 4996, 4995]
    assert sorted(r.idx for r in previews.every_kth(df, 1000).collect()) == [0, 1000, 2000, 3000, 4000]
