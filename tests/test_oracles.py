"""Every registered query against its SQL oracle (DuckDB) at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import duck, rows_of

from conftest import SF_SMALL

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_callable():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 75


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    c1, r1 = rows_of(df.columns, df.collect())
    r = con.execute(ORACLES[name])
    c2, r2 = rows_of([d[0] for d in r.description], r.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "orderskey" in df.columns and "etlupdateddatetime" in df.columns
