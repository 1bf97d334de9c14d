"""Every registered query of the core agrees with its SQL."""

from __future__ import annotations

import pytest
from oracle import connect, same

from segloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert registry.FLAGSHIP in QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, data, name):
    same(spark, connect(data), data, QUERIES[name], SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
