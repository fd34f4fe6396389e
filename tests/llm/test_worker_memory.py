"""What a worker holds: nothing of other stages, one value for all features that only occur or not."""

from types import SimpleNamespace

import numpy as np

from rowsift.llm import common
from rowsift.llm.linear import ftrl, sparse_rows


def test_objects_of_other_stages_are_given_back(monkeypatch):
    at, made = {"stage": 1}, []
    monkeypatch.setattr(common, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(stageId=lambda: at["stage"])))
    monkeypatch.setattr(common, "_kept", {})

    def make():
        made.append(at["stage"])
        return object()

    first = common.stage_kept("x", make)
    common.give_back()
    assert common.stage_kept("x", make) is first and made == [1]
    at["stage"] = 2
    assert common.stage_kept("x", make) is first          # asked for again before anything is given back
    at["stage"] = 3
    common.give_back()
    assert common.stage_kept("x", make) is not first and made == [1, 3]


def test_values_of_presence_are_stored_once():
    h = np.random.default_rng(5).integers(0, 2**63, 3000).astype(np.uint64)
    starts = np.array([0, 1000, 1000, 3000])
    rows = sparse_rows([(h, starts), (h[::-1].copy(), starts)], presence=True)
    assert [len(i) for i, _ in rows][1] == 0 and all(len(i) == len(x) and (x == 1).all() for i, x in rows)
    assert all(x.strides == (0,) for _, x in rows if len(x) > 1)
    whole = [(i, np.ones(len(i), np.float32)) for i, _ in rows]
    y = np.array([1.0, 0.0, 0.3])
    (a, b), (c, d) = (ftrl(r, y, 3, alpha=0.3, beta=1.0, l1=0.01, l2=1e-3) for r in (rows, whole))
    assert (a == c).all() and b == d and a.any()
