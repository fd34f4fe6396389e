"""Packing of numbers by byte planes: the bytes of the plain form, at less CPU time."""

from time import thread_time

import numpy as np
import pytest

from rowsift.llm.common import CODEC, PLANES, packed, unpacked


def transposed(x):
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


@pytest.mark.parametrize("kind", [np.uint8, np.uint32, np.int64, np.uint64, np.float32])
@pytest.mark.parametrize("size", [0, 1, 1000])
def test_planes_hold_the_same_bytes(kind, size):
    x = np.random.default_rng(3).integers(0, 200, size).astype(kind)
    cell = packed(x, True)
    assert cell == (x.nbytes | PLANES).to_bytes(8, "little") + CODEC.compress(transposed(x), asbytes=True)
    assert unpacked(cell, kind).dtype == kind and (unpacked(cell, kind) == x).all()


def test_planes_cost_less_than_a_transposed_copy():
    x = np.arange(1 << 20, dtype=np.int64)

    def least(f):
        took = []
        for _ in range(5):
            t = thread_time()
            f()
            took.append(thread_time() - t)
        return min(took)

    cell = packed(x, True)
    assert least(lambda: unpacked(cell, np.int64)) < 0.8 * least(lambda: transposed(x))
