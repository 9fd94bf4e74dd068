"""The corpus queries against their SQL counterparts, and the registry."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from ledgerstrata.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(registry.queries()[name](spark, SF), connect(SF), registry.oracle_sql()[name]) == []


def test_registered():
    names = entry_point.queries()
    assert [sum(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names
    assert set(registry.oracle_sql()) <= set(entry_point.oracle_sql())
