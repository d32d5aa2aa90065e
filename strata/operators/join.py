"""Joins: full-outer balances and proportional allocation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import round_half_away


def outer_balance(left: DataFrame, right: DataFrame, on: Sequence[str] | str = "year") -> DataFrame:
    """Full outer equi-join whose key columns are coalesced from both sides.

    ``USING``-style keys give one key column that is never NULL for matched or
    unmatched rows.  Measures from the missing side are NULL; callers decide
    between zero-fill (``coalesce(x, 0)``) and NULL-propagating ratios.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return left.join(right, on=keys, how="full_outer")


def allocate(
    totals: DataFrame,
    weights: DataFrame,
    on: Sequence[str],
    weight_col: str,
    total_col: str,
    out: str,
    decimals: int | None = 2,
) -> DataFrame:
    """Split each total over its members in proportion to their weights.

    ``out = total * w_i / sum(w over the same key)``.  Both inputs carry the
    join keys ``on`` (e.g. ``year``): this is an equi-join, never a cross
    product.  The weight sum per key is a grouped aggregate joined back, so no
    key has to fit one task; AQE broadcasts the weights at run time if their
    measured size is small.
    """
    keys = list(on)
    wsum = weights.groupBy(*keys).agg(F.sum(weight_col).alias("_wsum"))
    w = weights.join(wsum, on=keys, how="inner")
    joined = totals.join(w, on=keys, how="inner")
    share = f"CAST({total_col} AS DOUBLE) * CAST({weight_col} AS DOUBLE) / CAST(_wsum AS DOUBLE)"
    value = F.when(F.col("_wsum") > 0, F.expr(share))
    if decimals is not None:
        value = F.when(F.col("_wsum") > 0, round_half_away(share, decimals))
    return joined.withColumn(out, value).drop("_wsum")
