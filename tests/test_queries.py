"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import difference, reference_db
from checks.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return reference_db(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert entry_point.queries().items() >= QUERIES.items()
    assert entry_point.oracle_sql().items() >= ORACLE.items()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_its_sql(spark, db, name):
    assert difference(spark, db, name, SF_DIR) is None


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
