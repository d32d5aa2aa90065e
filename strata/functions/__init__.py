"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from strata.functions.columns import as_col, blank_to_null, strip_ws, year_of, year_range
from strata.functions.numeric import (
    MONEY,
    change_pct,
    money,
    pct,
    ratio,
    round_half_away,
)
from strata.functions.parse import (
    format_brl,
    parse_amount,
    parse_area,
    parse_brl,
    parse_count,
    parse_year,
)
from strata.functions.rules import (
    BIOME_RULES,
    CATEGORY_RULES,
    normalise_by_rules,
    normalise_state,
    rules_sql,
)

__all__ = [
    "BIOME_RULES",
    "CATEGORY_RULES",
    "MONEY",
    "as_col",
    "blank_to_null",
    "change_pct",
    "format_brl",
    "money",
    "normalise_by_rules",
    "normalise_state",
    "parse_amount",
    "parse_area",
    "parse_brl",
    "parse_count",
    "parse_year",
    "pct",
    "ratio",
    "round_half_away",
    "rules_sql",
    "strip_ws",
    "year_of",
    "year_range",
]
