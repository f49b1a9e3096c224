"""Every registered analysis with a SQL twin agrees with DuckDB (sf0.001)."""

import pytest

from tessera.plans.catalog import oracle_sql, queries

from .oracle_check import canon, duck

SMALL = "/root/testdata/sf0.001"
KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    got = queries()[key](spark, SMALL).toPandas()
    want = con.execute(oracle_sql()[key]).df()
    assert canon(got) == canon(want)
