import pytest

from dealspark.llm.oracle import ORACLE
from dealspark.llm.queries import QUERIES
from ..compare import compare, duck

from ..conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck(SF_SMALL))
    assert r["rows_spark"] == r["rows_oracle"] and r["columns_match"] and r["types_match"] and r["hash_match"], r
