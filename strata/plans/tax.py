"""Income-tax domain: raw CSV -> bronze -> silver -> gold by bracket; compiled allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import change_pct, pct, round_half_away
from strata.functions.rules import normalise_state
from strata.operators.aggregate import annual_sum
from strata.operators.cleaning import range_filter
from strata.operators.join import allocate
from strata.operators.window import with_prev, with_share
from strata.plans.common import rounded, type_columns
from strata.sources.tables import with_audit

RAW_COLUMNS = ["year", "income_bracket", "state", "num_declarations", "taxable_income_brl", "tax_due_brl"]
BRONZE_TYPES = {
    "year": "int",
    "income_bracket": "string",
    "state": "string",
    "num_declarations": "bigint",
    "taxable_income_brl": "double",
    "tax_due_brl": "double",
}

# Fixed value: silver year range.
SILVER_YEARS = (2008, 2025)


def bronze(
    raw: DataFrame, source_file: str | None = None, audit: bool = True, observation=None
) -> tuple[DataFrame, DataFrame]:
    """Typed bronze rows (plus lineage and audit columns) and rejected rows."""
    keep = ("_source_file",) if "_source_file" in raw.columns else ()
    good, bad = type_columns(raw, BRONZE_TYPES, keep=keep, observation=observation)
    good = with_audit(good, "_ingested_at", audit)
    if source_file is not None:
        good = good.withColumn("_source_file", F.lit(source_file))
    return good, bad


def silver(bronze_df: DataFrame, years: tuple[int, int] = SILVER_YEARS, audit: bool = True) -> DataFrame:
    """Upper-case state, amounts rounded, effective rate (0 when income is not positive)."""
    kept = range_filter(
        bronze_df,
        between={"year": years},
        conditions=[F.col("num_declarations") >= 0, F.col("tax_due_brl") >= 0],
    )
    out = kept.select(
        "year",
        "income_bracket",
        normalise_state("state").alias("state"),
        "num_declarations",
        round_half_away("taxable_income_brl", 2).alias("taxable_income_brl"),
        round_half_away("tax_due_brl", 2).alias("tax_due_brl"),
        pct("tax_due_brl", "taxable_income_brl", 2, 0.0).alias("effective_tax_rate_pct"),
    )
    return with_audit(out, "_processed_at", audit)


def gold_by_bracket(silver_df: DataFrame, audit: bool = True, rollup_marker: str = "ALL") -> DataFrame:
    """Per year and bracket over the national rows: totals, effective rate, share of tax, YoY %."""
    national = silver_df.where(F.col("state") == F.lit(rollup_marker))
    annual = annual_sum(
        national,
        ["year", "income_bracket"],
        {"total_taxable_income": "taxable_income_brl", "total_tax_due": "tax_due_brl"},
        counts={"total_declarations": "num_declarations"},
    )
    annual = annual.withColumn(
        "effective_rate_pct", pct("total_tax_due", "total_taxable_income", 2, 0.0)
    )
    shared = with_share(annual, ["year"], "total_tax_due", "pct_of_total_tax", decimals=2, default=0.0)
    trended = with_prev(shared, ["income_bracket"], "year", "total_tax_due", "prev_tax")
    out = trended.select(
        "year",
        "income_bracket",
        "total_declarations",
        rounded("total_taxable_income").alias("total_taxable_income"),
        rounded("total_tax_due").alias("total_tax_due"),
        "effective_rate_pct",
        "pct_of_total_tax",
        change_pct("total_tax_due", "prev_tax", 1).alias("yoy_growth_pct"),
    )
    return with_audit(out, "_computed_at", audit)


def allocate_compiled(yearly: DataFrame, brackets: DataFrame) -> DataFrame:
    """Yearly national totals x bracket weights -> raw tax rows.

    ``yearly``: (year, total_declarations, total_tax); ``brackets``: (year,
    income_bracket, decl_share, rate[, weight]), one row per bracket and year.
    Tax is split by ``weight`` (default ``decl_share * rate``); declarations by
    ``decl_share`` (truncated); income is ``tax / rate`` (0 when the rate is
    not positive).
    """
    weight = F.col("weight") if "weight" in brackets.columns else F.col("decl_share") * F.col("rate")
    w = brackets.withColumn("_w", weight)
    out = allocate(yearly, w, ["year"], "_w", "total_tax", "_tax", decimals=None)
    return out.select(
        F.col("year").cast("int").alias("year"),
        "income_bracket",
        F.lit("ALL").alias("state"),
        (F.col("total_declarations") * F.col("decl_share")).cast("bigint").alias("num_declarations"),
        round_half_away("CASE WHEN rate > 0 THEN _tax / rate ELSE 0.0D END", 2).alias("taxable_income_brl"),
        round_half_away("_tax", 2).alias("tax_due_brl"),
    )


BRACKET_ORDER = ["year", "income_bracket"]
