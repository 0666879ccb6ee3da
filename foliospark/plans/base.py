"""The tables of queries and of their SQL, filled by a decorator."""

from __future__ import annotations

from .derive import with_tables

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = with_tables(sql)
        return f

    return add
