"""The registered queries against their SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
CHECKS = {check.name: check.sql for check in entry.CHECKS}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_of_the_library_has_sql():
    assert all(CHECKS.values())
    assert CHECKS.items() <= entry.oracle_sql().items() and CHECKS.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", CHECKS)
def test_query(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, CHECKS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "name_masked", "department", "salary_hash", "start_date"]
