import importlib.util

import pytest
from oracle import differs

from pulsegrid.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, data, name):
    assert differs(spark, QUERIES[name], SQL[name], data) is None


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_other_queries_give_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert registry.queries().keys() <= entry.queries().keys() and set(entry.oracle_sql()) <= set(entry.queries())
    if importlib.util.find_spec("pulsegrid.llm") is None:
        assert entry.queries().keys() == registry.queries().keys()
