"""Scalar operators: ordered rules, range filters, guarded ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.columns import year_of, year_range
from strata.functions.numeric import pct, ratio, round_half_away
from strata.functions.rules import normalise_by_rules, normalise_state
from strata.operators.cleaning import range_filter
from strata.plans import tpch_analogues as A
from strata.plans.queries.registry import register
from strata.plans.queries.sql import NET_SQL

# ----------------------------------------------------------------------------
# Scalar operators: rules, filters, guarded ratios
# ----------------------------------------------------------------------------

# Fixed values of this analogue (not from the reference): ordered part-type
# rules with a multi-wildcard pattern and an unmatched passthrough (LARGE).
PART_TYPE_RULES = [
    (["%promo%"], "Promotional"),
    (["%s%a%l%", "%medium%"], "Compact"),
    (["%stand%", "%econ%"], "Regular"),
]


@register(
    "q_rule_normalise",
    """
SELECT p_partkey,
       CASE WHEN contains(lower(p_type), 'promo') THEN 'Promotional'
            WHEN regexp_matches(lower(p_type), 's.*a.*l') OR contains(lower(p_type), 'medium') THEN 'Compact'
            WHEN regexp_matches(lower(p_type), 'stand|econ') THEN 'Regular' ELSE p_type END AS type_group,
       upper(p_brand) AS brand_code, CAST(length(p_name) AS BIGINT) AS name_len
FROM part""",
)
def q_rule_normalise(spark, sf_dir):
    """Ordered LIKE rules on part type (multi-wildcard, order trap, passthrough), upper and length."""
    p = A.table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        normalise_by_rules("p_type", PART_TYPE_RULES).alias("type_group"),
        normalise_state("p_brand").alias("brand_code"),
        F.length("p_name").cast("bigint").alias("name_len"),
    )


SILVER_YEARS = (1996, 2000)
SILVER_PRICE_OPEN = (1000.0, 400000.0)


@register(
    "q_silver_filter",
    f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, upper(o_orderstatus) AS o_orderstatus,
       round(o_totalprice, 2) AS o_totalprice
FROM orders
WHERE year(o_orderdate) BETWEEN {SILVER_YEARS[0]} AND {SILVER_YEARS[1]}
  AND o_totalprice > {SILVER_PRICE_OPEN[0]} AND o_totalprice < {SILVER_PRICE_OPEN[1]}""",
)
def q_silver_filter(spark, sf_dir):
    """Silver-style filters: an inclusive year range (pushed to Parquet as a timestamp range) and open
    price bounds.
    """
    o = A.table(spark, sf_dir, "orders")
    lo, hi = SILVER_PRICE_OPEN
    kept = range_filter(
        o,
        conditions=[year_range("o_orderdate", *SILVER_YEARS), F.col("o_totalprice") > lo, F.col("o_totalprice") < hi],
    )
    return kept.select(
        "o_orderkey",
        year_of("o_orderdate").alias("year"),
        F.upper("o_orderstatus").alias("o_orderstatus"),
        round_half_away("o_totalprice", 2).alias("o_totalprice"),
    )


@register(
    "q_safe_ratio",
    f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {NET_SQL} AS net_price,
       CASE WHEN l_discount > 0 THEN round(l_tax / l_discount * 100, 2) ELSE 0 END AS tax_vs_discount_pct,
       CASE WHEN l_tax > 0 THEN round(l_discount / l_tax, 1) END AS discount_per_tax
FROM lineitem""",
)
def q_safe_ratio(spark, sf_dir):
    """Row-level rounding and guarded ratios over lineitem: zero and NULL denominators."""
    li = A.table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        A.net_price().alias("net_price"),
        pct("l_tax", "l_discount", 2, 0.0).alias("tax_vs_discount_pct"),
        ratio("l_discount", "l_tax", 1, None).alias("discount_per_tax"),
    )
