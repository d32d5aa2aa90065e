"""SQL fragments shared by the oracle texts.

The oracles state a KPI by its definition, row by row: what a row's earlier rows
of the same key hold, what its peers hold.  They use no window functions, so they
do not repeat the plans they are held against.
"""

from __future__ import annotations


# ----------------------------------------------------------------------------
# SQL fragments shared by the oracle texts
# ----------------------------------------------------------------------------

def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def yoy_sql(cur: str, prev: str, k: int = 1) -> str:
    return f"CASE WHEN {dbl(prev)} > 0 THEN round(({dbl(cur)} - {dbl(prev)}) / {dbl(prev)} * 100, {k}) END"


def _same(keys: list[str]) -> str:
    return " AND ".join(f"o.{k} = r.{k}" for k in keys)


def previous(rel: str, keys: list[str], value: str) -> str:
    """The value of the latest earlier year of the same keys (NULL without one)."""
    return f"(SELECT arg_max_null(o.{value}, o.year) FROM {rel} o WHERE {_same(keys)} AND o.year < r.year)"


def up_to_now(rel: str, keys: list[str], value: str) -> str:
    """The sum over this year and all earlier ones of the same keys."""
    return f"(SELECT sum(o.{value}) FROM {rel} o WHERE {_same(keys)} AND o.year <= r.year)"


def year_total(rel: str, value: str) -> str:
    return f"(SELECT sum(o.{value}) FROM {rel} o WHERE o.year = r.year)"


def place(rel: str, keys: list[str], value: str) -> str:
    """One more than the number of peers with a larger value."""
    return f"(SELECT 1 + count(*) FROM {rel} o WHERE {_same(keys)} AND o.{value} > r.{value})"


def trend_sql(rel: str, key: str, value: str, names: tuple[str, str, str]) -> str:
    """Value, running total, previous value and change of a yearly series ``rel(year, key, value)``."""
    now, total, before = names
    return f"""
SELECT year, {key}, round({dbl(now)}, 2) AS {now}, round({dbl(total)}, 2) AS {total}, round({dbl(before)}, 2) AS {before},
       {yoy_sql(now, before)} AS yoy_change_pct
FROM (SELECT r.year, r.{key}, r.{value} AS {now}, {up_to_now(rel, [key], value)} AS {total}, {previous(rel, [key], value)} AS {before} FROM {rel} r)"""


NET_SQL = "round(l_extendedprice * (1 - l_discount), 2)"
GEO_SQL = """
    SELECT s.s_suppkey, n.n_name, r.r_name
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey"""


def def_rows_sql(value_sql: str, biome_sql: str = "g.r_name") -> str:
    return f"""
    SELECT CAST(year(l.l_shipdate) AS BIGINT) AS year, {biome_sql} AS biome, g.n_name AS state,
           CAST({value_sql} AS DECIMAL(18,2)) AS area
    FROM lineitem l JOIN ({GEO_SQL}) g ON l.l_suppkey = g.s_suppkey"""
