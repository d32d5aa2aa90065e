"""Cross-domain KPIs over gold tables: fiscal balance and outcome vs spending.

Both re-aggregate gold to one row per year (sums of the rounded gold values,
exact as decimals) and full-outer-join the two yearly series, so years present
on one side only still appear.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import pct, ratio, round_half_away
from strata.operators.join import outer_balance
from strata.sources.tables import with_audit


# Gold values are already sums: re-aggregating them uses the widest exact type.
WIDE_MONEY = "decimal(38,2)"


def yearly(df: DataFrame, measure: str, out: str, where=None) -> DataFrame:
    """Re-aggregate a gold measure to one exact sum per year (optionally filtered)."""
    src = df if where is None else df.where(where)
    return src.groupBy("year").agg(F.sum(F.col(measure).cast(WIDE_MONEY)).alias(out))


def _zero(c: str) -> str:
    return f"coalesce({c}, CAST(0 AS DECIMAL(38,2)))"


def fiscal_balance(tax_gold: DataFrame, spending_gold: DataFrame, audit: bool = True) -> DataFrame:
    """Revenue vs spending per year: zero-filled amounts, balance, coverage % (NULL without spending)."""
    t = yearly(tax_gold, "total_tax_due", "total_tax_revenue")
    s = yearly(spending_gold, "executed_brl", "total_spending")
    j = outer_balance(t, s, "year")
    out = j.select(
        "year",
        round_half_away(_zero("total_tax_revenue"), 2).alias("irpf_revenue_brl"),
        round_half_away(_zero("total_spending"), 2).alias("total_spending_brl"),
        round_half_away(f"{_zero('total_tax_revenue')} - {_zero('total_spending')}", 2).alias("balance_brl"),
        pct("total_tax_revenue", "total_spending", 1, None).alias("irpf_covers_pct"),
    )
    return with_audit(out, "_computed_at", audit)


def outcome_vs_spend(
    biome_gold: DataFrame,
    spending_gold: DataFrame,
    category: str = "Environment",
    audit: bool = True,
) -> DataFrame:
    """Deforested area vs spending of one function per year; spending per km² (NULL without area)."""
    d = yearly(biome_gold, "area_km2", "total_deforested_km2")
    e = yearly(spending_gold, "executed_brl", "env_spending_brl", where=F.col("functional_category") == category)
    j = outer_balance(d, e, "year")
    out = j.select(
        "year",
        round_half_away(_zero("total_deforested_km2"), 2).alias("deforested_km2"),
        round_half_away(_zero("env_spending_brl"), 2).alias("env_spending_brl"),
        ratio("env_spending_brl", "total_deforested_km2", 0, None).alias("spending_per_km2_deforested"),
    )
    return with_audit(out, "_computed_at", audit)
