"""The registered operator queries against their SQL at sf0.001."""

import pytest

from tests.oracle_check import compare_frame, duckdb_connection
from tillroll.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, sf_small, name):
    con = duckdb_connection(sf_small)
    assert compare_frame(queries.QUERIES[name](spark, sf_small), queries.ORACLE_SQL[name], con) == "ok"
