"""Views over written gold files and parameterised SQL stages."""

from __future__ import annotations

from strata.plans import tpch_analogues as A
from strata.session import scratch_path
from strata.sources.tables import create_path_view, run_sql, write_table
from strata.plans.queries.registry import register
from strata.plans.queries.gold import ANNUAL_TREND_SQL, annual_trend

# ----------------------------------------------------------------------------
# Views and SQL stages
# ----------------------------------------------------------------------------

@register("q_gold_views", f"SELECT * FROM ({ANNUAL_TREND_SQL}) ORDER BY total_price DESC LIMIT 10")
def q_gold_views(spark, sf_dir):
    """Write a gold table, publish a view over its files and read a top-10 report through it."""
    path = scratch_path(spark, "gold-annual-trend")
    write_table(annual_trend(spark, sf_dir), path, partition_by=["c_mktsegment"], sort_by=["year"])
    create_path_view(spark, "gold_annual_trend", path)
    return spark.sql("SELECT * FROM gold_annual_trend ORDER BY total_price DESC LIMIT 10").select(
        "year", "c_mktsegment", "total_price", "cumulative_price", "prev_year_price", "yoy_change_pct"
    )


SQL_STAGE_TEXT = """
WITH per_customer AS (
    SELECT o_custkey, year(o_orderdate) AS year, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_price
    FROM {orders}
    WHERE o_orderdate >= make_timestamp_ntz(:first_year, 1, 1, 0, 0, 0)
      AND o_orderdate < make_timestamp_ntz(:last_year + 1, 1, 1, 0, 0, 0)
    GROUP BY 1, 2
), annual AS (
    SELECT p.year, c.c_mktsegment, sum(p.total_price) AS total_price
    FROM per_customer p JOIN {customer} c ON p.o_custkey = c.c_custkey GROUP BY 1, 2
)
SELECT CAST(year AS BIGINT) AS year, c_mktsegment, CAST(total_price AS DOUBLE) AS total_price,
       CAST(sum(total_price) OVER (PARTITION BY c_mktsegment ORDER BY year) AS DOUBLE) AS cumulative_price
FROM annual"""
SQL_STAGE_YEARS = (1996, 2000)


@register(
    "q_sql_stage",
    f"""
WITH annual AS (
    SELECT year(o.o_orderdate) AS year, c.c_mktsegment,
           sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total_price
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    WHERE year(o.o_orderdate) BETWEEN {SQL_STAGE_YEARS[0]} AND {SQL_STAGE_YEARS[1]}
    GROUP BY 1, 2
)
SELECT CAST(year AS BIGINT) AS year, c_mktsegment, CAST(total_price AS DOUBLE) AS total_price,
       CAST(sum(total_price) OVER (PARTITION BY c_mktsegment ORDER BY year) AS DOUBLE) AS cumulative_price
FROM annual""",
)
def q_sql_stage(spark, sf_dir):
    """A SQL-text stage with bound parameters (a per-year backfill window)."""
    return run_sql(
        spark,
        SQL_STAGE_TEXT,
        args={"first_year": SQL_STAGE_YEARS[0], "last_year": SQL_STAGE_YEARS[1]},
        frames={"orders": A.table(spark, sf_dir, "orders"), "customer": A.table(spark, sf_dir, "customer")},
    )
