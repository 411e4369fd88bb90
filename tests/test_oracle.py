"""Every registered query against its DuckDB oracle (sf0.001 by default; DRIVESTATS_TEST_SF to change)."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from drivestats.plans import queries as plans_queries
from tests.oracle_compare import compare, duck

#: Queries of the subpackage llm have their tests in tests/llm.
OWN = plans_queries.registry()
QUERIES = {name: query for name, query in contract.queries().items() if name in OWN}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) == set(OWN)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    problems, _, _, _ = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert not problems, problems


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert tuple(df.columns)[:2] == ("date", "hour")
