"""Every registered query against its DuckDB oracle (row count, column
names and kinds, order-insensitive value hash) on the smallest tables."""

import pytest

from .compare import compare, duck
from dealspark.plans.oracle import oracle_queries
from dealspark.plans.registry import registry

from .conftest import SF_SMALL

QUERIES = registry()
ORACLE = oracle_queries()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["columns_match"] and r["types_match"], r
    assert r["hash_match"], r
