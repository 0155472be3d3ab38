"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import checks
from checks.compare import compare, connect

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, DIRECTORY, name) is None


def test_every_query_has_an_oracle():
    assert set(checks.QUERIES) == set(checks.ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["Country", "Tier", "MatchURL"]
    assert set(entry.queries()) >= set(checks.QUERIES)
