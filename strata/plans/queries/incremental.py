"""Incremental ingestion and snapshot diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import year_of
from strata.plans import tpch_analogues as A
from strata.plans.common import type_columns
from strata.session import scratch_path
from strata.sources.csv import string_schema, write_csv
from strata.sources.tables import read_table
from strata.streaming.incremental import diff_snapshots, ingest_new_files
from strata.plans.queries.registry import register
from strata.plans.queries.sources import ORDERS_RAW, ORDERS_TYPES, count_by_year

# ----------------------------------------------------------------------------
# Incremental
# ----------------------------------------------------------------------------

def customer_v2(customer: DataFrame) -> DataFrame:
    """A second snapshot: BUILDING removed, MACHINERY balances changed, HOUSEHOLD re-keyed copies added."""
    kept = customer.where(F.col("c_mktsegment") != "BUILDING").withColumn(
        "c_acctbal",
        F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + F.lit(1.0)).otherwise(F.col("c_acctbal")),
    )
    added = customer.where(F.col("c_mktsegment") == "HOUSEHOLD").withColumn(
        "c_custkey", F.col("c_custkey") + F.lit(10_000_000_000)
    )
    return kept.unionByName(added)


@register(
    "q_snapshot_diff",
    """
WITH v1 AS (SELECT * FROM customer),
v2 AS (
    SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
    FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT c_custkey + 10000000000, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
)
SELECT CASE WHEN v1.c_custkey IS NULL THEN 'added'
            WHEN v2.c_custkey IS NULL THEN 'removed'
            WHEN v1.c_name IS NOT DISTINCT FROM v2.c_name AND v1.c_nationkey IS NOT DISTINCT FROM v2.c_nationkey
                 AND v1.c_acctbal IS NOT DISTINCT FROM v2.c_acctbal AND v1.c_mktsegment IS NOT DISTINCT FROM v2.c_mktsegment
            THEN 'unchanged' ELSE 'changed' END AS change_type,
       count(*) AS n_rows
FROM v1 FULL OUTER JOIN v2 ON v1.c_custkey = v2.c_custkey
GROUP BY 1""",
)
def q_snapshot_diff(spark, sf_dir):
    """Added / removed / changed / unchanged customers between two snapshots (one union + groupBy)."""
    v1 = A.table(spark, sf_dir, "customer")
    diff = diff_snapshots(v1, customer_v2(v1), keys=["c_custkey"])
    return diff.groupBy("change_type").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "q_incremental_ingest",
    """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY 1""",
)
def q_incremental_ingest(spark, sf_dir):
    """Two CSV drops into a landing folder, each picked up once by an AvailableNow stream."""
    root = scratch_path(spark, "incremental")
    landing, bronze, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint"
    o = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", year_of("o_orderdate").alias("year"), "o_totalprice", "o_orderpriority",
        "o_orderstatus",
    )
    schema = string_schema(ORDERS_RAW)
    for i, cond in enumerate([F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"]):
        write_csv(o.where(cond), f"{landing}/drop{i}", columns=ORDERS_RAW)
        ingest_new_files(
            spark,
            f"{landing}/*",
            schema,
            bronze,
            ckpt,
            transform=lambda df: type_columns(df, ORDERS_TYPES)[0],
            partition_by=["year"],
        )
    return count_by_year(read_table(spark, bronze))
