"""Registry of this subpackage's queries: name -> fn(spark, sf_dir) and name -> DuckDB SQL."""

from __future__ import annotations

QUERIES = {}
ORACLE_SQL = {}


def register(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its DuckDB form, or None when it is tested against brute force."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
