"""The registered queries on the smallest tables, against their SQL where there is some."""

import pytest

import __spark_entry__ as entry
from dimflow.llm.queries import QUERIES
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("query", [q for q in QUERIES if q.sql], ids=lambda q: q.name)
def test_query_against_sql(spark, con, query):
    assert difference(query.run(spark, SF_DIR), con, query.sql) is None


def test_all_are_registered():
    names = {q.name for q in QUERIES}
    assert names | {"pipeline"} <= entry.queries().keys()
    assert {q.name for q in QUERIES if q.sql} == names & entry.oracle_sql().keys()
