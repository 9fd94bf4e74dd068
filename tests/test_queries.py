"""Every registered query against its SQL counterpart on the given tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from ledgerstrata.testbed import oracle, queries as registry

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLE[name]) == []


def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.columns[0] == "company_name" and out.count() > 0
