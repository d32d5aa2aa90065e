"""Window analytics over *aggregated* frames: running totals, previous value,
year-over-year change, ranks, top-N and shares of a total.

All of these run after the grouped sum, so a window partition holds one row
per period (or per member of a period), never raw fact rows.  Every window is
partitioned: nothing is funnelled through a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.numeric import change_pct, pct
from strata.session import scratch_path


def _spec(partition_by: Sequence[str], order_by: Sequence[str] | str):
    if not partition_by:
        raise ValueError("window operators need partition keys; a global window runs in one task")
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    return Window.partitionBy(*partition_by).orderBy(*order)


def with_cumulative(
    df: DataFrame, partition_by: Sequence[str], order_by, measure: str, out: str
) -> DataFrame:
    """Running total with the default frame (RANGE UNBOUNDED PRECEDING .. CURRENT ROW).

    Peers with an equal ordering value are included together, as in SQL.
    """
    return df.withColumn(out, F.sum(measure).over(_spec(partition_by, order_by)))


def with_prev(
    df: DataFrame, partition_by: Sequence[str], order_by, measure: str, out: str
) -> DataFrame:
    """Value of the previous *row* in period order (gaps in years are skipped over)."""
    return df.withColumn(out, F.lag(measure, 1).over(_spec(partition_by, order_by)))


def with_prev_period(
    df: DataFrame, keys: Sequence[str], period: str, measure: str, out: str, step: int = 1
) -> DataFrame:
    """Value of the *calendar* previous period (``period - step``), NULL across a gap.

    ``with_prev`` takes the previous row, so after a missing year it compares
    with an older year.  This is an equi-join of the aggregated frame with
    itself shifted by ``step`` on (keys, period): no window and no pairs.
    """
    shifted = df.select(*keys, (F.col(period) + F.lit(step)).alias(period), F.col(measure).alias(out))
    return df.join(shifted, on=[*keys, period], how="left")


def with_trend(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by,
    measure: str,
    cumulative: str | None = None,
    previous: str | None = None,
) -> DataFrame:
    """Running total and previous value in one window pass (one shuffle, one sort)."""
    w = _spec(partition_by, order_by)
    cols = {}
    if cumulative:
        cols[cumulative] = F.sum(measure).over(w)
    if previous:
        cols[previous] = F.lag(measure, 1).over(w)
    return df.withColumns(cols)


def with_yoy(df: DataFrame, current: str, previous: str, out: str, decimals: int = 1) -> DataFrame:
    """``round((cur - prev) / prev * 100, k)`` when ``prev > 0``, else NULL."""
    return df.withColumn(out, change_pct(current, previous, decimals))


def with_rank(
    df: DataFrame,
    partition_by: Sequence[str],
    order_col: str,
    out: str,
    descending: bool = True,
) -> DataFrame:
    """``rank()`` (with gaps) per group; NULL measures sort last in both directions."""
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    w = Window.partitionBy(*partition_by).orderBy(order)
    return df.withColumn(out, F.rank().over(w).cast("bigint"))


def top_n(
    df: DataFrame,
    partition_by: Sequence[str],
    order_col: str,
    n: int,
    rank_col: str = "rank_in_group",
    descending: bool = True,
) -> DataFrame:
    """Rows whose rank is at most ``n`` (ties included).

    Catalyst plans a ``WindowGroupLimit`` on both sides of the shuffle, so
    only candidate rows are exchanged.
    """
    return with_rank(df, partition_by, order_col, rank_col, descending).where(F.col(rank_col) <= n)


def with_share(
    df: DataFrame,
    total_keys: Sequence[str],
    measure: str,
    out: str,
    decimals: int = 2,
    default: float | None = 0.0,
    total_col: str | None = None,
    method: str = "window",
) -> DataFrame:
    """Share of the group total, ``CASE WHEN total > 0 THEN round(x / total * 100, k) ELSE default``.

    ``df`` is an aggregated frame (one row per member and period).

    * ``method="window"`` (default): ``sum(x) OVER (PARTITION BY total_keys)``.
      The aggregate is computed once; the only extra cost is an exchange of
      the aggregated rows by period, which hold one row per member.
    * ``method="table"``: for years with very many members.  The aggregate is written, totals are a
      second aggregate (map-side first) over what was written, and are joined back, so no year's members
      meet in one task.
    * ``method="join"``: a second aggregate to one row per period, joined
      back (the literal two-CTE form); AQE broadcasts the totals at run time
      once their measured size is known to be small.  Spark does not share
      the two branches (column pruning makes their exchanges differ), so the
      input of ``df`` is computed twice; use it only when ``df`` is cached or
      read from a table.
    """
    tcol = total_col or f"_total_{measure}"
    if method == "window":
        joined = df.withColumn(tcol, F.sum(measure).over(Window.partitionBy(*total_keys)))
    elif method in ("join", "table"):
        if method == "table":
            path = scratch_path(df.sparkSession, "shares")
            df.write.parquet(path)
            df = df.sparkSession.read.parquet(path)
        totals = df.groupBy(*total_keys).agg(F.sum(measure).alias(tcol))
        joined = df.join(totals, on=list(total_keys), how="inner")
    else:
        raise ValueError("method must be 'window', 'table' or 'join'")
    joined = joined.withColumn(out, pct(measure, tcol, decimals, default))
    return joined if total_col else joined.drop(tcol)
