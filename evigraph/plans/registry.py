"""Every query of the library, by name, with its SQL counterpart where SQL can express it."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame callable under a name."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return keep
