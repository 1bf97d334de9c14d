"""The registered queries of the subpackage run, and agree with their SQL where they have one."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle import connect, same  # noqa: E402

from segloom.llm import registry  # noqa: E402

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, name):
    if name in SQL:
        same(spark, connect(data), data, QUERIES[name], SQL[name])
    else:
        rows = QUERIES[name](spark, data)
        kept = rows.collect()
        assert kept or name == "p8_limits"
        if name.endswith("_found"):
            assert len(kept) == len({tuple(r) for r in kept}) and not any(v is None for r in kept for v in r)
