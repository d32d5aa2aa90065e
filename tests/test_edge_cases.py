"""Empty inputs, one-sided joins and all-zero groups."""

from pyspark.sql import functions as F

from strata.operators import Check, count_rows, run_checks, with_share
from strata.plans import cross, deforestation, spending, tax

DEF_SCHEMA = "year int, biome string, state string, area_km2 double"
SPEND_GOLD = "year int, functional_category string, executed_brl double"
TAX_GOLD = "year int, income_bracket string, total_tax_due double"


def test_gold_jobs_on_empty_silver(spark):
    empty = spark.createDataFrame([], DEF_SCHEMA)
    assert deforestation.gold_by_biome(empty, audit=False).count() == 0
    assert deforestation.gold_by_biome(empty, mode="as_executed", audit=False).count() == 0
    assert deforestation.gold_by_state(empty, audit=False).count() == 0


def test_fiscal_balance_one_side_empty(spark):
    t = spark.createDataFrame([(2020, "a", 10.0)], TAX_GOLD)
    s = spark.createDataFrame([], SPEND_GOLD)
    rows = cross.fiscal_balance(t, s, audit=False).collect()
    assert [(r.year, r.irpf_revenue_brl, r.total_spending_brl, r.balance_brl, r.irpf_covers_pct) for r in rows] == [
        (2020, 10.0, 0.0, 10.0, None)
    ]


def test_outcome_vs_spend_other_category_only(spark):
    biome = spark.createDataFrame([(2020, "Amazonia", 4.0)], "year int, biome string, area_km2 double")
    s = spark.createDataFrame([(2020, "Health", 5.0), (2021, "Environment", 8.0)], SPEND_GOLD)
    rows = {r.year: r for r in cross.outcome_vs_spend(biome, s, audit=False).collect()}
    assert (rows[2020].env_spending_brl, rows[2020].spending_per_km2_deforested) == (0.0, None)
    assert (rows[2021].deforested_km2, rows[2021].env_spending_brl, rows[2021].spending_per_km2_deforested) == (
        0.0, 8.0, None)


def test_share_when_every_value_is_zero(spark):
    df = spark.createDataFrame([(2020, "a", 0.0), (2020, "b", 0.0)], "year int, c string, v double")
    assert {r.s for r in with_share(df, ["year"], "v", "s").collect()} == {0.0}


def test_checks_on_empty_table(spark):
    empty = spark.createDataFrame([], "x int")
    rows = run_checks(empty, [Check("rows", count_rows(), "gt", 0), Check("max", F.max("x"), "lte", 5)]).collect()
    assert [(r.check_name, r.value, r.passed) for r in rows] == [("rows", 0.0, False), ("max", None, False)]


def test_silver_filters_drop_out_of_range_and_negative(spark):
    bronze = spark.createDataFrame(
        [(1999, "A", "ALL", 5.0), (2000, "A", "ALL", 0.0), (2000, "A", "ALL", 100000.0), (2025, "A", "ALL", 1.0),
         (None, "A", "ALL", 1.0)], DEF_SCHEMA)
    assert [r.year for r in deforestation.silver(bronze, audit=False).collect()] == [2025]
    t = spark.createDataFrame([(2008, "x", "sp", -1, 1.0, 1.0), (2008, "x", "sp", 1, 0.0, 1.0),
                               (2008, "x", "sp", 1, 1.0, -1.0)],
                              "year int, income_bracket string, state string, num_declarations bigint, "
                              "taxable_income_brl double, tax_due_brl double")
    rows = tax.silver(t, audit=False).collect()
    assert [(r.state, r.effective_tax_rate_pct) for r in rows] == [("SP", 0.0)]
    s = spark.createDataFrame([(2000, "Saude", "d", 0.0, -1.0), (2000, "Saude", "d", 0.0, 1.0)],
                              "year int, functional_category string, description string, "
                              "budgeted_brl double, executed_brl double")
    assert [(r.functional_category, r.execution_rate_pct) for r in spending.silver(s, audit=False).collect()] == [
        ("Health", 0.0)]
