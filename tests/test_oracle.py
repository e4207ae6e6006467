"""Every registered query with oracle SQL, at the smallest scale."""

import pytest

from hooklens.plans import catalog
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
TEXTS = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(TEXTS) <= set(catalog.queries())


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_query_matches_oracle(spark, con, name):
    assert difference(catalog.queries()[name](spark, SF_DIR), con, TEXTS[name]) is None
