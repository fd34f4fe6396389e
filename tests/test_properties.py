"""Property tests of the arithmetic the exact operators rely on."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowsift.operators.population import Mutation, cut_point
from rowsift.operators.rowid import ordered_positions
from rowsift.operators.selection import largest_remainder


@given(st.dictionaries(st.integers(0, 50), st.integers(1, 10_000), min_size=1, max_size=12),
       st.floats(0.0, 1.0))
def test_largest_remainder(counts, frac):
    n = sum(counts.values())
    t = int(frac * n)
    alloc = largest_remainder(t, counts)
    assert sum(alloc.values()) == t
    for lab, a in alloc.items():
        exact = t * counts[lab] / n
        assert math.floor(exact) <= a <= math.floor(exact) + 1 and a <= counts[lab]


@given(st.integers(3, 10**12), st.floats(0, 1, exclude_max=True), st.floats(0, 1, exclude_max=True))
def test_keys_and_cut_in_range(n, ua, uc):
    mu = Mutation(ua, uc, rate=0.1)
    assert all(0 <= k < 1 << 31 for k in mu.keys()) and mu.count(n) == int(n * 0.1)
    assert Mutation(ua, uc, percent=0.0).count(n) == 1
    assert 1 <= cut_point(uc, n) <= n - 2


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 400), st.integers(1, 9))
def test_ordered_positions_dense(spark, n, parts):
    df = spark.range(n).select((F.col("id") * 7919 % 1000003).alias("k"))
    got = ordered_positions(df, ["k"], out_col="pos", num_partitions=parts).collect()
    pos = sorted((r.k, r.pos) for r in got)
    assert [p for _, p in pos] == list(range(n))
