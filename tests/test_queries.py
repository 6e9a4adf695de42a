"""Every registered query against its SQL twin, on whole tables."""

import pytest

from __spark_entry__ import entry, queries
from gleaner.plans.catalog import QUERIES
from gleaner.plans.oracle import ORACLE
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, connection, name):
    assert difference(spark, FOLDER, name, QUERIES, ORACLE, connection) is None


def test_entry(spark):
    ranked = entry(spark)
    assert ranked.columns == ["rank", "skill", "count", "percentage"]
    assert ranked.count() > 0
