"""Structural properties of every registered query's executed plan.

These guard the scale design: no cross products or nested-loop joins, no
unpartitioned windows, and column pruning on the large fact table.
"""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

LINEITEM_COLUMNS = 11


def _final_plan(df) -> str:
    df.collect()  # execute so the adaptive plan is final
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.LLM_QUERIES)))
def test_plan_shape(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # Window operators always carry partition keys: "Window [...], [keys], [order]".
    for args in re.findall(r"Arguments: \[.*?\], \[(.*?)\], \[", plan):
        assert args.strip(), f"unpartitioned window in {name}"
    for schema in re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan):
        assert schema.count(":") < LINEITEM_COLUMNS, f"lineitem read without pruning in {name}: {schema}"


# Queries whose fact rows must be aggregated before any shuffle.
PRE_AGGREGATED = [
    "q_annual_trend", "q_rank_in_year", "q_topn_per_year", "q_share_of_total", "q_effective_rate",
    "q_fiscal_balance", "q_outcome_vs_spend", "q_rollup_as_executed", "q_rollup_preferred",
    "q_allocate", "q_quality_report", "q_quality_ops",
]
RAW_MEASURES = ("l_extendedprice#", "l_quantity#", "l_discount#", "l_tax#", "o_totalprice#")


def _exchange_inputs(plan: str):
    blocks = re.split(r"\n\(\d+\) ", plan)
    for b in blocks:
        if b.startswith("Exchange") or b.startswith("ShuffleQueryStage"):
            m = re.search(r"Input \[\d+\]: \[(.*?)\]\n", b)
            if m:
                yield m.group(1)


@pytest.mark.parametrize("name", PRE_AGGREGATED)
def test_no_raw_fact_rows_in_shuffles(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF_SMALL))
    for inputs in _exchange_inputs(plan):
        cols = [c.strip() for c in inputs.split(",")]
        raw = [c for c in cols if c.startswith(RAW_MEASURES)]
        assert not raw, f"{name} shuffles raw fact columns {raw}"


def test_year_range_reaches_parquet(spark):
    plan = _final_plan(E.queries()["q_silver_filter"](spark, SF_SMALL))
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", plan).group(1)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "GreaterThan(o_totalprice" in pushed


# Each fact table is scanned once: no branch recomputes an input another branch already read.
SINGLE_SCANS = {
    "q_annual_trend": {"orders": 1, "customer": 1},
    "q_share_of_total": {"lineitem": 1},
    "q_effective_rate": {"lineitem": 1, "orders": 1},
    "q_rollup_preferred": {"lineitem": 1},
    "q_rank_in_year": {"lineitem": 1},
    "q_quarantine": {"orders": 1},
    "q_quality_ops": {"lineitem": 1},
}


@pytest.mark.parametrize("name", sorted(SINGLE_SCANS))
def test_fact_tables_scanned_once(spark, name):
    plan = _final_plan(E.queries()[name](spark, SF_SMALL))
    tree = plan.split("\n\n(1)", 1)[0]
    final_ids = set(re.findall(r"\((\d+)\)\s*$", tree.split("== Initial Plan ==", 1)[0], flags=re.M))
    counts = {}
    for node_id, body in re.findall(r"\n\((\d+)\) Scan parquet\s*\n(.*?)\n\n", plan, flags=re.S):
        if node_id in final_ids:
            loc = re.search(r"Location: \S+ \[(.*?)\]", body)
            table = loc.group(1).rsplit("/", 1)[-1].replace(".parquet", "") if loc else "?"
            counts[table] = counts.get(table, 0) + 1
    for table, n in SINGLE_SCANS[name].items():
        assert counts.get(table, 0) == n, (name, counts)


@pytest.fixture()
def no_broadcasts(spark):
    """What a large cluster plans: every join shuffles."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"]
    old = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_one_exchange_serves_the_order_aggregate_and_its_join(spark, no_broadcasts):
    from strata.plans import tpch_analogues as A

    plan = A.tax_rows(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(o_orderkey", plan)) == 1


@pytest.mark.parametrize("name", ["q_annual_trend", "q_allocate", "q_sql_stage", "q_gold_views", "q_posexplode_series"])
def test_orders_are_aggregated_before_the_customer_join(spark, no_broadcasts, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for block in re.findall(r"Exchange hashpartitioning\([^)]*\)[^\n]*\n[^\n]*", plan):
        assert "FileScan" not in block or "o_totalprice" not in block, block
