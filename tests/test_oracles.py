"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver's smoke contract."""

import pytest

from conftest import SF_SMALL
from tools.oracle_check import canon, duck

import __spark_entry__ as E
from rowsift.plans import catalog, q_selection
from rowsift.plans.sql_selection import EMBEDDINGS_BASE

catalog.load_all()
QUERIES = {k: v for k, v in E.queries().items() if k in catalog.QUERIES}
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}
SLOW_ROWS_ONLY = {"rf_classifier", "rf_regressor", "rf_evaluate", "feature_importance",
                  "cross_validate", "fitness_rf", "rf_evaluate_cv", "evolve_sequential", "search_defaults"}


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(QUERIES) - set(ORACLES) <= SLOW_ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def once(con, sql):
    """The oracle with its search replaced by a table of that search's steps, made once for all
    oracles that begin with it."""
    for i, search in enumerate((q_selection.EVO["search"], q_selection.SEQ["search"])):
        if search in sql:
            con.execute(f"CREATE TABLE IF NOT EXISTS steps_{i} AS {search} SELECT * FROM steps")
            return sql.replace(search, f"""WITH base AS ({EMBEDDINGS_BASE}),
search AS (SELECT g, row_id, mask_0 FROM steps_{i} WHERE solution IS NULL),
every AS (SELECT g AS generation, solution, n_selected, accuracy, fitness FROM steps_{i} WHERE solution IS NOT NULL)""")
    return sql


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(once(con, ORACLES[name]))
    exp = canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["row_id", "label"] and len(rows) > 0
