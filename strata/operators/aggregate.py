"""Grouped sums, including the rollup-row policies.

Sums run on exact decimals (see ``strata.functions.numeric.MONEY``): Spark
plans them as a partial aggregate before the shuffle and a final one after
it, so a key holding a third of the rows is collapsed map-side and never
lands in one task as raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import as_col
from strata.functions.numeric import MONEY, money

ROLLUP_MODES = ("prefer_rollup", "as_executed")


def annual_sum(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, object],
    exact: bool = True,
    counts: Mapping[str, object] | None = None,
    money_type: str = MONEY,
) -> DataFrame:
    """``SELECT keys, sum(m) AS name ... GROUP BY keys``.

    ``measures`` maps output name to a column (name or expression).  With
    ``exact`` the values are summed as ``money_type`` and stay decimal, so
    running totals and second-level totals over the result stay exact too;
    cast to DOUBLE at the end.  ``counts`` are integer measures summed as
    BIGINT.  Values the type cannot hold are an error, not a NULL inside the
    sum: raw tables reject them first (``type_columns``).
    """
    aggs: list[Column] = []
    for name, c in measures.items():
        value = money(c, money_type) if exact else as_col(c).cast("double")
        aggs.append(F.sum(value).alias(name))
    for name, c in (counts or {}).items():
        aggs.append(F.sum(as_col(c).cast("bigint")).alias(name))
    return df.groupBy(*keys).agg(*aggs)


def rollup_sum(
    df: DataFrame,
    keys: Sequence[str],
    marker_col: str,
    measure: str,
    out: str | None = None,
    marker: str = "ALL",
    mode: str = "prefer_rollup",
    exact: bool = True,
    money_type: str = MONEY,
) -> DataFrame:
    """Sum a measure per key where the input mixes rollup rows and detail rows.

    Rows whose ``marker_col`` equals ``marker`` (e.g. state ``'ALL'``) already
    hold the total of the detail rows of the same key.

    * ``prefer_rollup`` (the stated intent): per key, the sum of the rollup rows
      if there is one, else the sum of the detail rows.  One aggregate, no join.
    * ``as_executed``: the predicate
      ``m = 'ALL' OR m NOT IN (SELECT DISTINCT m ... WHERE m = 'ALL')`` whose
      subquery is not correlated: its key comparisons compare a row's keys with
      themselves, which only rows with a NULL key fail.  Its set is ``{'ALL'}``
      as soon as one rollup row without NULL keys exists anywhere, so rollup
      **and** detail rows are summed (double counting) and NULL markers drop;
      otherwise every row is kept.  Per key, the sums of rollup, detail and
      NULL-marker rows are aggregated once; the flag is a scalar subquery over
      the same aggregate, which Spark reads from the same exchange.  Keys with
      no kept row disappear, as with ``WHERE`` before ``GROUP BY``.
    """
    if mode not in ROLLUP_MODES:
        raise ValueError(f"mode must be one of {ROLLUP_MODES}, got {mode!r}")
    out = out or measure
    m = F.col(marker_col)
    value = money(measure, money_type) if exact else F.col(measure).cast("double")
    is_marker = m == F.lit(marker)
    if mode == "prefer_rollup":
        rolled = F.sum(F.when(is_marker, value))
        detail = F.sum(F.when(m != F.lit(marker), value))
        return df.groupBy(*keys).agg(F.coalesce(rolled, detail).alias(out))

    parts = (
        df.groupBy(*keys)
        .agg(
            F.sum(F.when(is_marker, value)).alias("_s_marker"),
            F.sum(F.when(m.isNotNull() & ~is_marker, value)).alias("_s_detail"),
            F.sum(F.when(m.isNull(), value)).alias("_s_null"),
            F.count(F.when(is_marker, F.lit(1))).alias("_n_marker"),
            F.count(F.when(m.isNotNull() & ~is_marker, F.lit(1))).alias("_n_detail"),
            F.count(F.when(m.isNull(), F.lit(1))).alias("_n_null"),
        )
    )
    whole_key = F.lit(True)
    for k in keys:
        whole_key = whole_key & F.col(k).isNotNull()
    has_rollup = parts.select((F.sum(F.when(whole_key, F.col("_n_marker"))) > 0).alias("f")).scalar()
    keep_null = ~F.coalesce(has_rollup, F.lit(False))
    kept_rows = F.col("_n_marker") + F.col("_n_detail") + F.when(keep_null, F.col("_n_null")).otherwise(F.lit(0))
    parts_kept = [F.col("_s_marker"), F.col("_s_detail"), F.when(keep_null, F.col("_s_null"))]
    total = _nullable_sum(parts_kept)
    return parts.where(kept_rows > 0).select(*keys, total.alias(out))


def _nullable_sum(cols: Sequence[Column]) -> Column:
    """SQL ``sum`` over several partial sums: NULL only when every part is NULL."""
    any_value = None
    acc = None
    for c in cols:
        any_value = c.isNotNull() if any_value is None else (any_value | c.isNotNull())
        term = F.coalesce(c, F.lit(0))
        acc = term if acc is None else acc + term
    return F.when(any_value, acc)
