"""Registration of queries."""

from __future__ import annotations


def registry():
    """A table of queries, a table of their SQL, and the decorator that fills both."""
    queries: dict = {}
    oracles: dict[str, str] = {}

    def query(sql: str | None = None):
        def register(f):
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return register

    return queries, oracles, query
