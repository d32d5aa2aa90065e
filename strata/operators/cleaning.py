"""Row-level cleaning: range filters and good/bad splits (quarantine)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def range_filter(
    df: DataFrame,
    between: Mapping[str, tuple[float, float]] | None = None,
    conditions: list[Column] | None = None,
) -> DataFrame:
    """Keep rows inside every inclusive ``BETWEEN`` range and every condition.

    NULLs fail ``BETWEEN`` and comparisons, so they drop, as in SQL ``WHERE``.
    On a table partitioned by the range column this becomes a partition filter;
    otherwise a pushed Parquet filter.
    """
    pred = None
    for name, (lo, hi) in (between or {}).items():
        c = F.col(name).between(lo, hi)
        pred = c if pred is None else pred & c
    for c in conditions or []:
        pred = c if pred is None else pred & c
    return df if pred is None else df.where(pred)


def tag_valid(df: DataFrame, checks: Mapping[str, Column], reason_col: str = "_reject_reason", first: Column | None = None) -> DataFrame:
    """Add the name of the first failed check (NULL for a good row); see ``split_valid``.  A reason in ``first`` goes before."""
    if not checks:
        raise ValueError("tag_valid needs at least one check")
    reason = None
    for name, pred in checks.items():
        failed = ~F.coalesce(pred, F.lit(False))
        reason = F.when(failed, F.lit(name)) if reason is None else reason.when(failed, F.lit(name))
    return df.withColumn(reason_col, reason if first is None else F.coalesce(first, reason))


def split_valid(
    df: DataFrame,
    checks: Mapping[str, Column],
    reason_col: str = "_reject_reason",
    observation: Observation | None = None,
    first: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad) instead of rejecting a whole file.

    ``checks`` maps a reason name to a predicate that a good row satisfies; a
    NULL predicate counts as failed.  Bad rows carry the name of the first
    failed check.  Both outputs are lazy filters over the same input.  With
    an ``observation`` the counts ``rows`` and ``rejected`` are collected while
    the good rows are written, so the bad rows need a pass of their own only
    when there are any.
    """
    tagged = tag_valid(df, checks, reason_col, first)
    if observation is not None:
        tagged = tagged.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(reason_col).isNotNull()).alias("rejected"),
        )
    good = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    bad = tagged.where(F.col(reason_col).isNotNull())
    return good, bad
