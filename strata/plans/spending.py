"""Federal spending domain: raw CSV / API items -> bronze -> silver -> gold by function."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import change_pct, pct, round_half_away
from strata.functions.rules import CATEGORY_RULES, normalise_by_rules
from strata.operators.aggregate import annual_sum
from strata.operators.cleaning import range_filter, split_valid
from strata.operators.window import with_prev, with_share
from strata.plans.common import rounded, type_columns
from strata.sources.json_items import split_payloads
from strata.sources.series import explode_series
from strata.sources.tables import with_audit

RAW_COLUMNS = ["year", "functional_category", "description", "budgeted_brl", "executed_brl"]
BRONZE_TYPES = {
    "year": "int",
    "functional_category": "string",
    "description": "string",
    "budgeted_brl": "double",
    "executed_brl": "double",
}

# Silver year range; executed share of the budget in compiled series.
SILVER_YEARS = (2000, 2025)
EXECUTION_SHARE = 0.95
SERIES_UNIT = 1e9


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


def from_api_items(items: DataFrame, year_col: str = "year") -> DataFrame:
    """API items (category, description, amount) -> raw spending rows.

    The API reports one amount; it is used for both budgeted and executed.
    """
    return items.select(
        F.col(year_col).cast("int").alias("year"),
        F.col("category").alias("functional_category"),
        F.col("description"),
        F.col("amount").alias("budgeted_brl"),
        F.col("amount").alias("executed_brl"),
    )


def api_items_to_raw(items: DataFrame, year_col: str = "year") -> tuple[DataFrame, DataFrame]:
    """API items -> (raw spending rows, rejected items).

    An item whose amount text could not be read (NULL amount) is rejected
    with its reason instead of vanishing later in the silver filters.
    """
    good, bad = split_valid(items, {"bad_amount": F.col("amount").isNotNull()})
    return from_api_items(good, year_col), bad


def api_raw(payloads: DataFrame, json_col: str = "value", keep: tuple[str, ...] = ("_source_file",)) -> DataFrame:
    """All that a drop of API payloads says, as raw rows for a run: good items, and rejects with their reason.

    Payloads are parsed once.  Items whose amount cannot be read (``bad_amount``) and payloads that
    cannot be read (their text in ``_raw_record``) carry ``_reject_reason`` and end in the run's quarantine.
    """
    keep = [c for c in keep if c in payloads.columns]
    items, rejected = split_payloads(payloads, json_col, keep=keep, fields={"year": "int"})
    unread = F.col("amount").isNull()
    item = F.to_json(F.struct("year", "category", "description"))
    rows = items.select(
        F.col("year").cast("int").alias("year"), F.col("category").alias("functional_category"), "description",
        F.col("amount").alias("budgeted_brl"), F.col("amount").alias("executed_brl"), *keep,
        F.when(unread, F.lit("bad_amount")).alias("_reject_reason"), F.when(unread, item).alias("_raw_record"),
    )
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in BRONZE_TYPES.items()]
    return rows.unionByName(rejected.select(*nothing, *keep, "_reject_reason", F.col("payload").alias("_raw_record")))


def from_series(series: DataFrame, key: str, values_col: str, first_year: int) -> DataFrame:
    """Compiled yearly series (one array per function) -> raw rows.

    Values are in billions; executed is ``EXECUTION_SHARE`` of budgeted.
    """
    rows = explode_series(series, [key], values_col, first_year, value="_v")
    return rows.select(
        F.col("year").cast("int").alias("year"),
        F.col(key).alias("functional_category"),
        F.col(key).alias("description"),
        (F.col("_v") * F.lit(SERIES_UNIT)).alias("budgeted_brl"),
        (F.col("_v") * F.lit(EXECUTION_SHARE) * F.lit(SERIES_UNIT)).alias("executed_brl"),
    )


def silver(bronze_df: DataFrame, years: tuple[int, int] = SILVER_YEARS, audit: bool = True) -> DataFrame:
    """Normalised category, amounts rounded, execution rate; negative executed dropped."""
    kept = range_filter(bronze_df, between={"year": years}, conditions=[F.col("executed_brl") >= 0])
    out = kept.select(
        "year",
        normalise_by_rules("functional_category", CATEGORY_RULES).alias("functional_category"),
        "description",
        round_half_away("budgeted_brl", 2).alias("budgeted_brl"),
        round_half_away("executed_brl", 2).alias("executed_brl"),
        pct("executed_brl", "budgeted_brl", 1, 0.0).alias("execution_rate_pct"),
    )
    return with_audit(out, "_processed_at", audit)


def gold_by_function(silver_df: DataFrame, audit: bool = True) -> DataFrame:
    """Per year and function: amounts, share of the year's executed total, nominal YoY %."""
    annual = annual_sum(
        silver_df, ["year", "functional_category"], {"executed_brl": "executed_brl", "budgeted_brl": "budgeted_brl"}
    )
    shared = with_share(annual, ["year"], "executed_brl", "pct_of_total", decimals=2, default=0.0)
    trended = with_prev(shared, ["functional_category"], "year", "executed_brl", "prev_year_brl")
    out = trended.select(
        "year",
        "functional_category",
        rounded("executed_brl").alias("executed_brl"),
        rounded("budgeted_brl").alias("budgeted_brl"),
        "pct_of_total",
        change_pct("executed_brl", "prev_year_brl", 1).alias("yoy_nominal_growth_pct"),
    )
    return with_audit(out, "_computed_at", audit)


def function_order():
    """Output order of the by-function table: year, then largest executed amount."""
    return [F.col("year"), F.col("executed_brl").desc()]
