"""Deforestation domain: raw CSV -> bronze -> silver -> gold (by biome, by state)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import change_pct, round_half_away
from strata.functions.rules import BIOME_RULES, normalise_by_rules, normalise_state
from strata.operators.aggregate import annual_sum, rollup_sum
from strata.operators.cleaning import range_filter
from strata.operators.window import with_prev, with_rank, with_trend
from strata.operators.yearly import update_trend
from strata.plans.common import rounded, type_columns
from strata.sources.tables import with_audit

RAW_COLUMNS = ["year", "biome", "state", "area_km2"]
BRONZE_TYPES = {"year": "int", "biome": "string", "state": "string", "area_km2": "double"}

# The silver sanity ranges.
SILVER_YEARS = (2000, 2025)
AREA_OPEN_RANGE = (0.0, 100000.0)


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


def silver(
    bronze_df: DataFrame,
    years: tuple[int, int] = SILVER_YEARS,
    area_open_range: tuple[float, float] = AREA_OPEN_RANGE,
    audit: bool = True,
) -> DataFrame:
    """Normalised biome and state, area rounded to 2 decimals, sanity filters."""
    lo, hi = area_open_range
    kept = range_filter(
        bronze_df,
        between={"year": years},
        conditions=[F.col("area_km2") > lo, F.col("area_km2") < hi],
    )
    out = kept.select(
        "year",
        normalise_by_rules("biome", BIOME_RULES).alias("biome"),
        normalise_state("state").alias("state"),
        round_half_away("area_km2", 2).alias("area_km2"),
    )
    return with_audit(out, "_processed_at", audit)


def gold_by_biome(silver_df: DataFrame, mode: str = "prefer_rollup", audit: bool = True) -> DataFrame:
    """Annual area per biome with running total, previous year and YoY %.

    ``mode`` chooses how 'ALL' rollup rows and state rows combine (see
    ``rollup_sum``): ``prefer_rollup`` (intent) or ``as_executed``.
    """
    annual = rollup_sum(silver_df, ["year", "biome"], "state", "area_km2", mode=mode)
    trend = with_trend(annual, ["biome"], "year", "area_km2", cumulative="cumulative_km2", previous="prev_year_km2")
    out = trend.select(
        "year",
        "biome",
        rounded("area_km2").alias("area_km2"),
        rounded("cumulative_km2").alias("cumulative_km2"),
        rounded("prev_year_km2").alias("prev_year_km2"),
        change_pct("area_km2", "prev_year_km2", 1).alias("yoy_change_pct"),
    )
    return with_audit(out, "_computed_at", audit)


def update_gold_by_biome(silver_df: DataFrame, path: str, years, mode: str = "prefer_rollup") -> DataFrame:
    """The by-biome table after some ``years`` of silver changed, from a state kept at ``path`` (see ``operators.yearly``).

    Silver is read for those years only, and only they and later years of the state are written.  With
    ``as_executed``, whose flag looks at all years, every year has to be among them.
    """
    annual = rollup_sum(silver_df.where(F.col("year").isin(sorted(years))), ["year", "biome"], "state", "area_km2", mode=mode)
    state = update_trend(path, annual, ["biome"], "area_km2", years)
    return state.select(
        "year",
        "biome",
        rounded("area_km2").alias("area_km2"),
        rounded("total").alias("cumulative_km2"),
        rounded("before").alias("prev_year_km2"),
        change_pct("area_km2", "before", 1).alias("yoy_change_pct"),
    )


def gold_by_state(silver_df: DataFrame, audit: bool = True) -> DataFrame:
    """Annual area per (biome, state) without rollup rows, previous year, YoY % and rank in year."""
    detail = silver_df.where(F.col("state") != F.lit("ALL"))
    annual = annual_sum(detail, ["year", "biome", "state"], {"area_km2": "area_km2"})
    ranked = with_prev(annual, ["biome", "state"], "year", "area_km2", "prev_year_km2")
    ranked = with_rank(ranked, ["year", "biome"], "area_km2", "rank_in_year")
    out = ranked.select(
        "year",
        "biome",
        "state",
        rounded("area_km2").alias("area_km2"),
        rounded("prev_year_km2").alias("prev_year_km2"),
        change_pct("area_km2", "prev_year_km2", 1).alias("yoy_change_pct"),
        "rank_in_year",
    )
    return with_audit(out, "_computed_at", audit)


# Output orderings of the gold tables (for writers that keep files sorted).
BIOME_ORDER = ["biome", "year"]


def state_order():
    """Output order of the by-state table: latest year first, then biome, then largest area."""
    return [F.col("year").desc(), F.col("biome"), F.col("area_km2").desc()]
