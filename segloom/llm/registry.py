"""All queries of the subpackage."""

from __future__ import annotations

from segloom.llm import language_queries, text_queries, truncation_queries, turn_queries

_MODULES = [turn_queries, language_queries, text_queries, truncation_queries]


def queries() -> dict:
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
