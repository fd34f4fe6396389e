"""All queries of the package are registered; SQL oracles agree on whole tables."""

import pytest

from conftest import SF_SMALL
from tools.oracle_check import canon, duck

from rowsift.llm import catalog


def test_one_query_per_operator():
    names = set(catalog.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 1 + len(catalog.MODULES))} | {"pipeline"}
    assert len(names) == 1 + len(catalog.MODULES)


@pytest.mark.parametrize("name", sorted(catalog.oracles()))
def test_oracle(spark, name):
    con = duck(SF_SMALL)
    df = catalog.queries()[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(catalog.oracles()[name])
    assert got == canon([d[0] for d in res.description], res.fetchall())
