"""How query modules list their queries."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    queries: dict = {}
    sql: dict = {}

    def query(statement: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if statement is not None:
                sql[f.__name__] = statement
            return f

        return add

    return queries, sql, query
