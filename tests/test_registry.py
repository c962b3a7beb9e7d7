"""Every registered query against its SQL on the smallest tables."""

import pytest

import oracle
from registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, rows = oracle.check(spark, con, name, SF_DIR)
    assert verdict in ("equal", "rows only"), verdict
    assert rows >= 0
