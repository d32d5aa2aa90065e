"""The query registry: name -> fn(spark, sf_dir) and name -> oracle SQL."""

from __future__ import annotations

QUERIES = {}
ORACLE_SQL = {}


def register(name: str, sql: str | None):
    """Register a query function; ``sql`` is its DuckDB oracle (None for rows-only checks)."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco
