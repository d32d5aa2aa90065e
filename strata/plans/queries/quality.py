"""Quality gates (Q1 - Q7): one scan per table, comparator matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.quality import Check, count_rows, count_where, null_rate, run_checks, run_suite
from strata.plans import tpch_analogues as A
from strata.plans.queries.registry import register

# ----------------------------------------------------------------------------
# Quality gates (Q1 - Q7)
# ----------------------------------------------------------------------------

def _quality_suite(spark, sf_dir):
    customer = A.table(spark, sf_dir, "customer")
    lineitem = A.table(spark, sf_dir, "lineitem")
    orders = A.table(spark, sf_dir, "orders")
    return [
        ("customer", customer, [
            Check("row_count", count_rows(), "gt", 0),
            Check("negative_balance", count_where(F.col("c_acctbal") < 0), "eq", 0),
            Check("null_segment", count_where(F.col("c_mktsegment").isNull()), "eq", 0),
        ]),
        ("lineitem", lineitem, [
            Check("row_count", count_rows(), "gt", 0),
            Check("null_shipdate", count_where(F.col("l_shipdate").isNull()), "eq", 0),
            Check("negative_quantity", count_where(F.col("l_quantity") < 0), "eq", 0),
            Check("max_discount", F.max("l_discount"), "between", (0.0, 0.1)),
            Check("tax_null_rate", null_rate("l_tax"), "lte", 0.01),
        ]),
        ("orders", orders, [
            Check("row_count", count_rows(), "gt", 0),
            Check("null_orderdate", count_where(F.col("o_orderdate").isNull()), "eq", 0),
            Check("min_totalprice", F.min("o_totalprice"), "gt", 0),
        ]),
    ]


def _check_sql(table: str, name: str, value_sql: str, op: str, lo, hi=None) -> str:
    v = f"CAST(({value_sql}) AS DOUBLE)"
    lo_s = "CAST(NULL AS DOUBLE)" if lo is None else f"CAST({lo} AS DOUBLE)"
    hi_s = "CAST(NULL AS DOUBLE)" if hi is None else f"CAST({hi} AS DOUBLE)"
    pred = {
        "gt": f"v > {lo_s}", "gte": f"v >= {lo_s}", "lt": f"v < {lo_s}", "lte": f"v <= {lo_s}",
        "eq": f"v = {lo_s}", "between": f"{lo_s} <= v AND v <= {hi_s}", "not_null": "v IS NOT NULL AND v > 0",
    }[op]
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, v AS value, '{op}' AS op, "
        f"{lo_s} AS threshold_lo, {hi_s} AS threshold_hi, coalesce({pred}, false) AS passed "
        f"FROM (SELECT {v} AS v FROM {table})"
    )


QUALITY_REPORT_SQL = "\nUNION ALL\n".join([
    _check_sql("customer", "row_count", "count(*)", "gt", 0),
    _check_sql("customer", "negative_balance", "count(*) FILTER (WHERE c_acctbal < 0)", "eq", 0),
    _check_sql("customer", "null_segment", "count(*) FILTER (WHERE c_mktsegment IS NULL)", "eq", 0),
    _check_sql("lineitem", "row_count", "count(*)", "gt", 0),
    _check_sql("lineitem", "null_shipdate", "count(*) FILTER (WHERE l_shipdate IS NULL)", "eq", 0),
    _check_sql("lineitem", "negative_quantity", "count(*) FILTER (WHERE l_quantity < 0)", "eq", 0),
    _check_sql("lineitem", "max_discount", "max(l_discount)", "between", 0.0, 0.1),
    _check_sql("lineitem", "tax_null_rate", "avg(CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END)", "lte", 0.01),
    _check_sql("orders", "row_count", "count(*)", "gt", 0),
    _check_sql("orders", "null_orderdate", "count(*) FILTER (WHERE o_orderdate IS NULL)", "eq", 0),
    _check_sql("orders", "min_totalprice", "min(o_totalprice)", "gt", 0),
])


@register("q_quality_report", QUALITY_REPORT_SQL)
def q_quality_report(spark, sf_dir):
    """Quality checks on customer, lineitem and orders: one aggregate scan per table, one row per check."""
    return run_suite(_quality_suite(spark, sf_dir))


# Comparator matrix at exact boundaries, all from one scan of lineitem.
QUALITY_OPS = [
    ("min_qty_gte_1", "min(l_quantity)", lambda: F.min("l_quantity"), "gte", 1.0, None),
    ("min_qty_gt_1", "min(l_quantity)", lambda: F.min("l_quantity"), "gt", 1.0, None),
    ("max_disc_lte", "max(l_discount)", lambda: F.max("l_discount"), "lte", 0.1, None),
    ("max_disc_lt", "max(l_discount)", lambda: F.max("l_discount"), "lt", 0.1, None),
    ("max_disc_eq", "max(l_discount)", lambda: F.max("l_discount"), "eq", 0.1, None),
    ("max_qty_between", "max(l_quantity)", lambda: F.max("l_quantity"), "between", 1.0, 50.0),
    ("neg_tax_not_null", "count(*) FILTER (WHERE l_tax < 0)", lambda: count_where(F.col("l_tax") < 0),
     "not_null", None, None),
    ("rows_not_null", "count(*)", count_rows, "not_null", None, None),
    ("null_value_gt", "max(CASE WHEN l_quantity < 0 THEN l_quantity END)",
     lambda: F.max(F.when(F.col("l_quantity") < 0, F.col("l_quantity"))), "gt", 0.0, None),
]


@register(
    "q_quality_ops",
    "\nUNION ALL\n".join(_check_sql("lineitem", n, s, op, lo, hi) for n, s, _, op, lo, hi in QUALITY_OPS),
)
def q_quality_ops(spark, sf_dir):
    """Every comparator at its exact boundary, from one aggregate scan of lineitem."""
    checks = [
        Check(n, expr(), op, (lo, hi) if op == "between" else (0 if lo is None else lo))
        for n, _, expr, op, lo, hi in QUALITY_OPS
    ]
    return run_checks(A.table(spark, sf_dir, "lineitem"), checks, "lineitem")
