"""Queries that SQL can express, against DuckDB."""

import pytest

from hooklens.llm import oracle, queries
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    assert difference(queries.queries()[name](spark, SF_DIR), connect(SF_DIR), oracle.oracle_sql()[name]) is None
