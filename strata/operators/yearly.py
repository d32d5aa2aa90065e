"""Yearly sums with running totals, kept up to date year by year.

The state of a trend is a versioned table by year: per key and year the exact sum, the running total up
to it and the sum of the year before.  When some years of the facts change, their sums are worked out
again from those years alone, totals are resumed from the last row before the first changed year, and only
that year and later ones are written.  The result equals a full recompute.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.sources.versions import is_versioned, read_version, write_version


def update_trend(path: str, sums: DataFrame, keys: Sequence[str], value: str, years: Collection[int], period: str = "year") -> DataFrame:
    """Bring the trend at ``path`` up to date; returns it (``period``, ``keys``, ``value``, ``total``, ``before``).

    ``sums`` holds one row per key and changed year, ``years`` all changed years: one that ``sums`` lacks
    has no rows any more.  Years before the first changed one are neither read again from the facts nor written.
    """
    spark = sums.sparkSession
    first = min(years)
    rows = sums.where(F.col(period).isin(sorted(years))).select(period, *keys, value)
    seeds, dropped = None, []
    if is_versioned(spark, path):
        state = read_version(spark, path)
        later = state.where(F.col(period) >= first)
        dropped = [f"{period}={r[0]}" for r in later.select(period).distinct().collect()]  # a row per year
        rows = rows.unionByName(later.where(~F.col(period).isin(sorted(years))).select(period, *keys, value))
        last = F.max_by(F.struct(value, "total"), period)
        seeds = state.where(F.col(period) < first).groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(last.alias("_seed"))
    along = Window.partitionBy(*keys).orderBy(period)
    summed = rows.withColumn("_sum", F.sum(value).over(along)).withColumn("_prev", F.lag(F.struct(value)).over(along))
    if seeds is not None:
        on = None
        for k in keys:
            same = F.col(k).eqNullSafe(F.col(f"_{k}"))
            on = same if on is None else on & same
        summed = summed.join(seeds, on, "left")
        total, before = F.col("_seed.total"), F.coalesce(F.col("_prev").getField(value), F.when(F.col("_prev").isNull(), F.col(f"_seed.{value}")))
    else:
        total, before = F.lit(None).cast(summed.schema["_sum"].dataType), F.col("_prev").getField(value)
    out = summed.select(
        F.col(period), *keys, value, F.coalesce(total + F.col("_sum"), total, F.col("_sum")).cast(summed.schema["_sum"].dataType).alias("total"), before.alias("before"))
    write_version(out, path, [period], overwrite="partitions", drop=dropped)
    return read_version(spark, path).select(period, *keys, value, "total", "before")
