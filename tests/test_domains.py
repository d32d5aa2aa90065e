"""Domain jobs on the canned fixture rows against the hand-derived values (FIXTURES F5)."""

import pytest
from pyspark.sql import functions as F

from strata.plans import cross, deforestation, spending, tax
from tests import fixtures as fx

MONEY_TOL = 0.011


@pytest.fixture(scope="module")
def def_silver(spark):
    bronze, bad = deforestation.bronze(fx.deforestation_raw(spark), audit=False)
    assert bad.count() == 0
    return deforestation.silver(bronze, audit=False).cache()


@pytest.fixture(scope="module")
def spend_gold(spark):
    bronze, _ = spending.bronze(fx.spending_raw(spark), audit=False)
    return spending.gold_by_function(spending.silver(bronze, audit=False), audit=False).cache()


@pytest.fixture(scope="module")
def tax_gold(spark):
    bronze, _ = tax.bronze(fx.tax_raw(spark), audit=False)
    return tax.gold_by_bracket(tax.silver(bronze, audit=False), audit=False).cache()


def _by_year(df):
    return {r.year: r for r in df.collect()}


def test_silver_normalises_and_counts(def_silver):
    assert def_silver.count() == 57
    assert {r.biome for r in def_silver.select("biome").distinct().collect()} == {"Amazonia"}


@pytest.mark.parametrize("mode", ["prefer_rollup", "as_executed"])
def test_gold_by_biome(def_silver, mode):
    g = _by_year(deforestation.gold_by_biome(def_silver, mode=mode, audit=False))
    assert (g[2000].area_km2, g[2000].cumulative_km2, g[2000].prev_year_km2, g[2000].yoy_change_pct) == (
        18226.0, 18226.0, None, None)
    assert (g[2001].area_km2, g[2001].cumulative_km2, g[2001].prev_year_km2, g[2001].yoy_change_pct) == (
        18165.0, 36391.0, 18226.0, -0.3)
    assert (g[2018].area_km2, g[2018].cumulative_km2, g[2018].yoy_change_pct) == (7536.0, 234011.0, 8.5)
    if mode == "prefer_rollup":
        assert (g[2019].area_km2, g[2019].cumulative_km2, g[2019].yoy_change_pct) == (10129.0, 244140.0, 34.4)
        assert (g[2024].area_km2, g[2024].cumulative_km2, g[2024].prev_year_km2, g[2024].yoy_change_pct) == (
            6288.0, 294886.0, 9001.0, -30.1)
    else:
        assert (g[2019].area_km2, g[2019].cumulative_km2, g[2019].yoy_change_pct) == (19908.0, 253919.0, 164.2)
        assert (g[2024].area_km2, g[2024].cumulative_km2, g[2024].prev_year_km2, g[2024].yoy_change_pct) == (
            11858.0, 351190.0, 16806.0, -29.4)


def test_gold_by_state(def_silver):
    rows = {(r.year, r.state): r for r in deforestation.gold_by_state(def_silver, audit=False).collect()}
    pa = rows[(2020, "PA")]
    assert (pa.area_km2, pa.prev_year_km2, pa.yoy_change_pct, pa.rank_in_year) == (3997.0, 3862.0, 3.5, 1)
    assert sorted(y for (y, s) in rows if s == "AC") == [2019, 2020]
    assert rows[(2021, "MA")].rank_in_year == 5 and rows[(2021, "RO")].rank_in_year == 4
    assert not any(s == "ALL" for (_, s) in rows)


def test_spending_shares(spend_gold):
    g = {(r.year, r.functional_category): r for r in spend_gold.collect()}
    expect_2000 = {"Health": 20.43, "Education": 11.19, "Social Security": 52.53, "Defense": 8.75,
                   "Social Assistance": 2.43, "Environment": 1.02, "Science & Technology": 1.70,
                   "Public Safety": 1.95}
    expect_2024 = {"Health": 13.23, "Education": 10.52, "Social Security": 60.24, "Defense": 5.70,
                   "Social Assistance": 8.48, "Environment": 0.24, "Science & Technology": 0.54,
                   "Public Safety": 1.05}
    for cat, pct in expect_2000.items():
        assert g[(2000, cat)].pct_of_total == pytest.approx(pct, abs=0.005)
    for cat, pct in expect_2024.items():
        assert g[(2024, cat)].pct_of_total == pytest.approx(pct, abs=0.005)
    assert sum(r.executed_brl for (y, _), r in g.items() if y == 2000) == pytest.approx(195.320e9)
    assert g[(2001, "Health")].yoy_nominal_growth_pct == 4.8


def test_spending_execution_rate(spark):
    bronze, _ = spending.bronze(fx.spending_raw(spark), audit=False)
    rates = {r[0] for r in spending.silver(bronze, audit=False).select("execution_rate_pct").distinct().collect()}
    assert rates == {95.0}


def test_tax_by_bracket_2008(tax_gold):
    g = {(r.year, r.income_bracket): r for r in tax_gold.collect()}
    expect = [
        ("Ate 2 SM", 8820000, 673076923076.92, 13461538461.54, 2.0, 10.36),
        ("2 a 5 SM", 7056000, 538461538461.54, 26923076923.08, 5.0, 20.71),
        ("5 a 10 SM", 3780000, 288461538461.54, 23076923076.92, 8.0, 17.75),
        ("10 a 20 SM", 2520000, 192307692307.69, 23076923076.92, 12.0, 17.75),
        ("20 a 40 SM", 1512000, 115384615384.62, 20769230769.23, 18.0, 15.98),
        ("40 a 80 SM", 1008000, 76923076923.08, 16923076923.08, 22.0, 13.02),
        ("Acima de 80 SM", 504000, 38461538461.54, 5769230769.23, 15.0, 4.44),
    ]
    for name, decl, income, due, rate, share in expect:
        r = g[(2008, name)]
        assert r.total_declarations == decl
        assert r.total_taxable_income == pytest.approx(income, abs=MONEY_TOL)
        assert r.total_tax_due == pytest.approx(due, abs=MONEY_TOL)
        assert (r.effective_rate_pct, r.pct_of_total_tax) == (rate, share)
        assert g[(2009, name)].yoy_growth_pct == -3.8


def test_fiscal_balance(tax_gold, spend_gold):
    g = _by_year(cross.fiscal_balance(tax_gold, spend_gold, audit=False))
    assert g[2000].irpf_revenue_brl == 0.0 and g[2000].irpf_covers_pct is None
    assert g[2024].balance_brl == pytest.approx(-1070.300e9, abs=1.0)
    assert g[2024].irpf_covers_pct == 23.6
    assert g[2008].balance_brl == pytest.approx(-261.875e9, abs=1.0)
    assert g[2008].irpf_covers_pct == 33.2
    assert g[2009].total_spending_brl == pytest.approx(428.83e9, abs=1.0) and g[2009].irpf_covers_pct == 29.1


def test_outcome_vs_spend(def_silver, spend_gold):
    for mode, expect_2024 in (("prefer_rollup", 528785.0), ("as_executed", 280401.0)):
        biome = deforestation.gold_by_biome(def_silver, mode=mode, audit=False)
        g = _by_year(cross.outcome_vs_spend(biome, spend_gold, audit=False))
        assert g[2000].spending_per_km2_deforested == 109459.0
        assert g[2024].spending_per_km2_deforested == expect_2024
        assert g[2010].env_spending_brl == pytest.approx(3.99e9, abs=1.0)


def test_bronze_quarantines_bad_casts(spark):
    raw = spark.createDataFrame([("2020", "x", "PA", "1,5"), ("20x", "x", "PA", "2")],
                                "year string, biome string, state string, area_km2 string")
    good, bad = deforestation.bronze(raw, audit=False)
    assert good.count() == 0
    reasons = sorted(r._reject_reason for r in bad.collect())
    assert reasons == ["bad_area_km2", "bad_year"]


def test_audit_columns_present(def_silver, spark):
    g = deforestation.gold_by_biome(def_silver)
    assert "_computed_at" in g.columns
    assert g.select(F.countDistinct("_computed_at")).first()[0] == 1


def test_bronze_integer_cast_rounds_half_to_even(spark, tmp_path):
    """A fractional year column is read as DOUBLE and cast half to even (2.5 -> 2, 3.5 -> 4).

    That is the SQL engine's DOUBLE -> INTEGER rule once its CSV sniffer types the column as
    DOUBLE.  (DuckDB 2.0 can also push a bare ``year::INTEGER`` into its CSV reader, which
    then rounds ties away from zero; raw years are whole numbers in every known source.)
    """
    import duckdb

    path = tmp_path / "raw.csv"
    path.write_text("year,biome,state,area_km2\n2.5,A,ALL,1\n3.5,A,ALL,1\n2020.7,A,ALL,1\n-0.5,A,ALL,1\n")
    con = duckdb.connect()
    via_double = [r[1] for r in con.execute(
        f"SELECT typeof(year), year::INTEGER FROM read_csv_auto('{path}', header=true)").fetchall()]
    raw = spark.read.option("header", True).csv(str(path))
    good, _ = deforestation.bronze(raw, audit=False)
    assert [r.year for r in good.collect()] == via_double == [2, 4, 2021, 0]
