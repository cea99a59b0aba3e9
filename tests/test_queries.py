"""Every named query against its SQL on the smallest tables."""

import pytest
from compare import difference, duck

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, SF_DIR).count() > 0
        return
    problem = difference(spark, connection, SF_DIR, QUERIES[name], ORACLES[name])
    # Small tables leave a few reports without rows; the contents were equal then.
    assert problem in (None, "no rows"), problem


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns == ["source", "subset", "number_of_papers", "percent_of_papers"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
