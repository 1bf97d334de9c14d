"""All queries of the core."""

from __future__ import annotations

from segloom.plans import interval_queries, ledger_queries, segment_queries, store_queries

_MODULES = [segment_queries, store_queries, ledger_queries, interval_queries]
FLAGSHIP = "search_context"


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
