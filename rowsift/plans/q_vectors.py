"""Index-vector queries over the driver tables.

Vectors: ``events`` (idx = event_id, dense from 0; value, user_id) and
``orders`` (idx = o_orderkey, dense from 0; o_totalprice, o_custkey).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formats
from ..operators import partitions, previews, ranks, reductions, vectors
from ..operators.rowid import with_row_id
from ..sources.tables import scan_table
from .catalog import register

N_EV = "(SELECT count(*) FROM events)"


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def ev(spark, d):
    return scan_table(spark, d, "events").select(F.col("event_id").alias("idx"), "value",
                                                  "user_id", "ts")


def orders(spark, d):
    return scan_table(spark, d, "orders").select(F.col("o_orderkey").alias("idx"),
                                                 "o_totalprice", "o_custkey")


def idiv(col, k: int):
    return F.expr(f"`{col}` div {int(k)}") if isinstance(col, str) else F.floor(col / k)


# ------------------------------------------------------------------ generation

@register("gen_index", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_id,
       l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""")
def q_gen_index(spark, d):
    """Dense positions for a table without a dense key (lineitem), in key order,
    by per-partition offsets (no single-task window)."""
    li = scan_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                  "l_suppkey")
    return with_row_id(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@register("vec_const", "SELECT event_id AS idx, 100 AS v FROM events")
def q_vec_const(spark, d):
    return ev(spark, d).select("idx", vectors.const(100).alias("v"))


@register("vec_ramp", "SELECT event_id AS idx, event_id AS v FROM events")
def q_vec_ramp(spark, d):
    return ev(spark, d).select("idx", vectors.ramp("idx").alias("v"))


@register("vec_ramp_desc", f"SELECT event_id AS idx, {N_EV} - 1 - event_id AS v FROM events")
def q_vec_ramp_desc(spark, d):
    e = ev(spark, d)
    n = e.count()
    return e.select("idx", vectors.ramp_desc(n, "idx").alias("v"))


@register("vec_affine", f"SELECT event_id AS idx, {dbl(1.0)} + {dbl(0.2)} * event_id AS v FROM events")
def q_vec_affine(spark, d):
    return ev(spark, d).select("idx", vectors.affine(1.0, 0.2, "idx").alias("v"))


@register("vec_add_index", "SELECT event_id AS idx, value + event_id AS v FROM events")
def q_vec_add_index(spark, d):
    return ev(spark, d).select("idx", vectors.add_index("value", "idx").alias("v"))


ZIP_SQL = ("SELECT event_id AS idx, value AS a, value * value + user_id AS b, user_id AS c FROM events")


def second_vector():
    return F.col("value") * F.col("value") + F.col("user_id")


def zipped(spark, d):
    e = ev(spark, d).select("idx", F.col("value").alias("a"), F.col("user_id").alias("c"))
    b = ev(spark, d).select("idx", second_vector().alias("b"))
    return vectors.zip_join([e, b], "idx")


@register("zip_join", ZIP_SQL)
def q_zip_join(spark, d):
    """Positional alignment of two equally long vectors over the event positions."""
    return zipped(spark, d).select("idx", "a", "b", "c")


@register("vec_add", f"SELECT idx, a + b AS v FROM ({ZIP_SQL})")
def q_vec_add(spark, d):
    return zipped(spark, d).select("idx", vectors.add("a", "b").alias("v"))


@register("vec_mul", f"SELECT idx, a * b AS v FROM ({ZIP_SQL})")
def q_vec_mul(spark, d):
    return zipped(spark, d).select("idx", vectors.mul("a", "b").alias("v"))


@register("vec_square", "SELECT event_id AS idx, user_id * user_id AS v FROM events")
def q_vec_square(spark, d):
    return ev(spark, d).select("idx", vectors.square("user_id").alias("v"))


@register("vec_parity_power", """
SELECT event_id AS idx,
       CASE WHEN event_id % 2 = 0 THEN value * value ELSE value * value * value END AS v
FROM events""")
def q_vec_parity_power(spark, d):
    return ev(spark, d).select("idx", vectors.parity_power("value", "idx").alias("v"))


@register("vec_lincomb2", f"SELECT idx, 2 * a + 3 * b AS v FROM ({ZIP_SQL})")
def q_vec_lincomb2(spark, d):
    return zipped(spark, d).select("idx", vectors.lincomb2("a", "b", 2, 3).alias("v"))


@register("vec_lincomb3",
          f"SELECT idx, {dbl(2.5)} * a + {dbl(1.5)} * (b + c) AS v FROM ({ZIP_SQL})")
def q_vec_lincomb3(spark, d):
    return zipped(spark, d).select("idx", vectors.lincomb3("a", "b", "c", 2.5, 1.5).alias("v"))


SCALED = dict(k=4, j=2, g=3, h=0.5)
SCALED_SQL = (f"SELECT idx, a / 4 - b * 2 * 3 + c * 3 * {dbl(0.5)} AS v FROM ({ZIP_SQL})")


@register("vec_scaled_expr", SCALED_SQL)
def q_vec_scaled_expr(spark, d):
    """x/k - y*j*g + z*g*h, data-parallel: one fused projection."""
    return zipped(spark, d).select("idx", vectors.scaled_expr("a", "b", "c", **SCALED).alias("v"))


@register("vec_scaled_expr_tasks", SCALED_SQL)
def q_vec_scaled_expr_tasks(spark, d):
    """Same expression, task-parallel: one job per term, combined by zip_join."""
    e = ev(spark, d)
    xs = e.select("idx", "value")
    zs = e.select("idx", F.col("user_id").alias("value"))
    ys = e.select("idx", second_vector().alias("value"))
    return vectors.scaled_expr_tasks(xs, ys, zs, **SCALED)


@register("filter_even", "SELECT event_id AS idx, value FROM events WHERE event_id % 2 = 0")
def q_filter_even(spark, d):
    return vectors.filter_even(ev(spark, d).select("idx", "value"), "idx")


@register("cyclic_partition", "SELECT event_id AS idx, event_id % 128 AS lane FROM events")
def q_cyclic_partition(spark, d):
    return ev(spark, d).select("idx", partitions.cyclic_partition("idx", 128).alias("lane"))


@register("block_partition",
          f"SELECT event_id AS idx, CAST(floor(event_id * 8 / {N_EV}) AS BIGINT) AS part FROM events")
def q_block_partition(spark, d):
    e = ev(spark, d)
    n = e.count()
    return e.select("idx", partitions.block_partition("idx", n, 8).alias("part"))


@register("chunk_assign", f"""
WITH c AS (SELECT {N_EV} // 8 AS q, {N_EV} % 8 AS r)
SELECT event_id AS idx,
       CAST(CASE WHEN event_id < c.r * (c.q + 1) THEN event_id // (c.q + 1)
            ELSE c.r + (event_id - c.r * (c.q + 1)) // c.q END AS BIGINT) AS chunk
FROM events, c""")
def q_chunk_assign(spark, d):
    """numpy.array_split of the events vector over 8 workers."""
    e = ev(spark, d)
    n = e.count()
    return e.select("idx", partitions.chunk_assign("idx", n, 8).alias("chunk"))


# ------------------------------------------------------------------ reductions

@register("sum_total", "SELECT CAST(sum(user_id) AS BIGINT) AS total FROM events")
def q_sum_total(spark, d):
    return reductions.sum_total(ev(spark, d), "user_id")


@register("all_equal", f"""
SELECT min(v) = max(v) AS all_equal, arg_min(v, idx) AS first_value
FROM (SELECT event_id AS idx, event_id + ({N_EV} - 1 - event_id) AS v FROM events)""")
def q_all_equal(spark, d):
    """Ascending plus descending ramp over the events index: all equal n-1."""
    e = ev(spark, d)
    n = e.count()
    v = vectors.add(vectors.ramp("idx"), vectors.ramp_desc(n, "idx"))
    return reductions.all_equal(e.select("idx", v.alias("value")), "value", "idx")


@register("all_equal_target", f"""
SELECT count(*) FILTER (WHERE value <> {dbl(100.0)}) AS n_failed,
       min(event_id) FILTER (WHERE value <> {dbl(100.0)}) AS first_failed_idx,
       arg_min(value, event_id) FILTER (WHERE value <> {dbl(100.0)}) AS first_failed_value
FROM events""")
def q_all_equal_target(spark, d):
    return reductions.all_equal_target(ev(spark, d), 100.0, "value", "idx")


@register("verify_expected", f"""
WITH v AS (SELECT event_id AS idx,
                  CASE WHEN event_id % 2 = 0 THEN value * value ELSE value * value * value END AS value,
                  CASE WHEN event_id % 2 = 0 THEN pow(value, 2) ELSE pow(value, 3) END AS e
           FROM events),
b AS (SELECT * FROM v WHERE abs(value - e) > {dbl(1e-05)})
SELECT (SELECT count(*) FROM b) AS n_mismatch, (SELECT min(idx) FROM b) AS first_idx,
       (SELECT arg_min(e, idx) FROM b) AS first_expected, (SELECT arg_min(value, idx) FROM b) AS first_actual""")
def q_verify_expected(spark, d):
    """Parity power of every event value checked against pow() within an absolute
    1e-5: mismatches, and the first one's index, expected and actual value."""
    e = ev(spark, d)
    v = e.select("idx", vectors.parity_power("value", "idx").alias("value"),
                 F.when(F.pmod("idx", F.lit(2)) == 0, F.pow("value", F.lit(2)))
                 .otherwise(F.pow("value", F.lit(3))).alias("e"))
    return reductions.verify_expected(v, F.col("e"), "value", "idx", eps=1e-5)


@register("residual_sample", f"""
SELECT idx, {dbl(2.5)} * a + {dbl(1.5)} * (b + c) AS value,
       {dbl(2.5)} * a + {dbl(1.5)} * b + {dbl(1.5)} * c AS expected,
       abs(({dbl(2.5)} * a + {dbl(1.5)} * (b + c)) - ({dbl(2.5)} * a + {dbl(1.5)} * b + {dbl(1.5)} * c)) AS abs_diff
FROM ({ZIP_SQL}) WHERE idx % 1000 = 0""")
def q_residual_sample(spark, d):
    z = zipped(spark, d).select("idx", vectors.lincomb3("a", "b", "c", 2.5, 1.5).alias("value"),
                                "a", "b", "c")
    expected = F.lit(2.5) * F.col("a") + F.lit(1.5) * F.col("b") + F.lit(1.5) * F.col("c")
    return reductions.residual_sample(z, expected, 1000, "value", "idx")


# ------------------------------------------------------------------ ranks, sorts

@register("rank_positions",
          "SELECT event_id AS idx, user_id, rank() OVER (ORDER BY user_id) - 1 AS position FROM events")
def q_rank_positions(spark, d):
    return ranks.rank_positions(ev(spark, d).select("idx", "user_id"), "user_id")


@register("count_smaller", """
SELECT o_orderkey AS idx, o_custkey, rank() OVER (ORDER BY o_custkey) - 1 AS n_smaller FROM orders""")
def q_count_smaller(spark, d):
    return ranks.count_smaller(orders(spark, d).select("idx", "o_custkey"), "o_custkey")


@register("rank_sort", """
SELECT row_number() OVER (ORDER BY user_id, event_id) - 1 AS position, event_id AS idx, user_id
FROM events""")
def q_rank_sort(spark, d):
    return ranks.rank_sort(ev(spark, d).select("idx", "user_id"), "user_id", "idx")


@register("scatter_by_position", f"""
SELECT r.range AS slot, coalesce(p.v, 0) AS user_id
FROM range(0, {N_EV}) r
LEFT JOIN (SELECT DISTINCT slot, v FROM (SELECT rank() OVER (ORDER BY user_id) - 1 AS slot,
                                               user_id AS v FROM events)) p
  ON r.range = p.slot""")
def q_scatter_by_position(spark, d):
    e = ev(spark, d).select("idx", "user_id")
    return ranks.scatter_by_position(e, e.count(), "user_id")


@register("is_sorted", """
SELECT count(*) FILTER (WHERE prev > ts) = 0 AS is_sorted,
       count(*) FILTER (WHERE prev > ts) AS n_inversions
FROM (SELECT ts, lag(ts) OVER (ORDER BY event_id) AS prev FROM events)""")
def q_is_sorted(spark, d):
    return ranks.is_sorted(ev(spark, d).select("idx", "ts"), "ts", "idx")


@register("is_sorted_values", """
SELECT count(*) FILTER (WHERE prev > value) = 0 AS is_sorted,
       count(*) FILTER (WHERE prev > value) AS n_inversions
FROM (SELECT value, lag(value) OVER (ORDER BY event_id) AS prev FROM events)""")
def q_is_sorted_values(spark, d):
    return ranks.is_sorted(ev(spark, d).select("idx", "value"), "value", "idx")


# ------------------------------------------------------------------ previews

@register("head_k", "SELECT event_id AS idx, value FROM events WHERE event_id < 10")
def q_head_k(spark, d):
    return previews.head_k(ev(spark, d).select("idx", "value"), 10)


@register("tail_k", "SELECT event_id AS idx, value FROM events ORDER BY event_id DESC LIMIT 5")
def q_tail_k(spark, d):
    return previews.tail_k(ev(spark, d).select("idx", "value"), 5)


@register("every_kth", "SELECT event_id AS idx, value FROM events WHERE event_id % 1000 = 0")
def q_every_kth(spark, d):
    return previews.every_kth(ev(spark, d).select("idx", "value"), 1000)


# ------------------------------------------------------------------ formats

@register("format_equation",
          "SELECT event_id AS idx, printf('%d * %d = %d', 10, event_id, 10 * event_id) AS text FROM events")
def q_format_equation(spark, d):
    i = F.col("idx")
    return ev(spark, d).select("idx", formats.format_equation(F.lit(10), i, F.lit(10) * i)
                               .alias("text"))


@register("format_indexed", """
SELECT event_id AS idx, printf('V[%d] = %d', event_id,
       2 * (2 * event_id) + 3 * (3 * event_id)) AS text
FROM events""")
def q_format_indexed(spark, d):
    i = F.col("idx")
    v = vectors.lincomb2(F.lit(2) * i, F.lit(3) * i, 2, 3)
    return ev(spark, d).select("idx", formats.format_indexed("V", i, v).alias("text"))


@register("format_rows_of_10", """
SELECT event_id // 10 AS line, string_agg(CAST(user_id AS VARCHAR), ' ' ORDER BY event_id) AS text
FROM events GROUP BY 1""")
def q_format_rows_of_10(spark, d):
    return formats.rows_of(ev(spark, d), 10, "idx", "user_id")
