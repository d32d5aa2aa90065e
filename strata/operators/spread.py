"""Running totals, previous rows, ranks and top-N for keys that don't fit one task.

A window puts all rows of a key into one task.  Here rows are dealt by ranges of (key, order), so a
key with very many rows lies in many tasks, and so do rows that tie in the order.  Windows work inside
a range only.  What a range needs from others is little: a row per range and key that spans several of
them (totals, counts, the last row, and the same for the values at its borders), over which small
windows carry the sums on.  Results are those of the window functions, ties across borders included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

SALTS = 64  # parts of a key in which the candidates of a top-N are found


def _placed(df: DataFrame, keys: Sequence[str], order: list[Column], ranges: int | None) -> DataFrame:
    """``df``, written in ranges of (keys, order): ``_part`` numbers the ranges, ``_no`` the rows in order."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [*keys, *order, F.col("_in")]  # the last one parts rows that tie
    path = scratch_path(spark, "ranges")
    dealt = df.withColumn("_in", F.monotonically_increasing_id()).repartitionByRange(n, *by).sortWithinPartitions(*by)
    dealt.drop("_in").withColumn("_no", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_no", 33)).write.parquet(path)
    return spark.read.parquet(path)


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str) -> DataFrame:
    on = None
    for a, b in pairs:
        c = F.col(a).eqNullSafe(F.col(b))
        on = c if on is None else on & c
    return left.join(right, on, how).drop(*[b for _, b in pairs])


def _spanning(rows: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per range and key, for keys that lie in several ranges (at most two such keys a range)."""
    summary = rows.groupBy("_part", *keys).agg(*aggregates)
    path = scratch_path(rows.sparkSession, "range-summary")
    summary.write.parquet(path)
    summary = rows.sparkSession.read.parquet(path)
    many = summary.groupBy(*keys).count().where("count > 1").select(*[F.col(k).alias(f"_m_{k}") for k in keys])
    return _same(summary, many, [(k, f"_m_{k}") for k in keys], "left_semi") if keys else summary


def _carried(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with what their range and key carries (nulls where the key lies in one range)."""
    pairs = [("_part", "_c_part"), *[(k, f"_c_{k}") for k in keys]]
    renamed = table.withColumnsRenamed({a: b for a, b in pairs})
    return _same(rows, renamed, pairs, "left")


def running_total(
    df: DataFrame, keys: Sequence[str], order_by: str, measure: str, out: str, previous: str | None = None, ranges: int | None = None
) -> DataFrame:
    """``sum(measure) OVER (PARTITION BY keys ORDER BY order_by)``, peers included, and ``lag(measure)`` as ``previous``.

    NULL order values come first, as in a window.  Among peers, ``previous`` follows one fixed order of
    the rows; where the order has no ties it is ``with_prev``'s.
    """
    rows = _placed(df, keys, [F.col(order_by)], ranges)
    kind = rows.select(F.sum(measure).alias("s")).schema["s"].dataType
    at_last = F.col("_last").eqNullSafe(F.col(order_by))
    inside = Window.partitionBy("_part", *keys)
    marked = rows.withColumn("_first", F.min_by(order_by, "_no").over(inside)).withColumn("_last", F.max_by(order_by, "_no").over(inside))
    table = _spanning(
        marked, keys, F.sum(measure).alias("_sum"), F.max_by(F.struct(measure), "_no").alias("_row"), F.first("_first").alias("_first"), F.first("_last").alias("_last"),
        F.sum(F.when(F.col("_first").eqNullSafe(F.col(order_by)), F.col(measure))).alias("_sum_first"), F.sum(F.when(at_last, F.col(measure))).alias("_sum_last"),
    )
    along = Window.partitionBy(*keys).orderBy("_part")
    # Sums of a border value in later ranges: peers that the range doesn't hold.
    value_rows = table.select(*keys, "_part", F.col("_first").alias("_value"), F.col("_sum_first").alias("_s")).unionByName(
        table.where(~F.col("_first").eqNullSafe(F.col("_last"))).select(*keys, "_part", F.col("_last").alias("_value"), F.col("_sum_last").alias("_s")))
    after = Window.partitionBy(*keys, "_value").orderBy("_part").rowsBetween(1, Window.unboundedFollowing)
    more = value_rows.withColumn("_more", F.sum("_s").over(after)).where("_more IS NOT NULL").select(
        F.col("_part").alias("_x_part"), *[F.col(k).alias(f"_x_{k}") for k in keys], F.col("_value").alias("_x_value"), "_more")
    carry = table.withColumn("_before", F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_prev_row", F.lag("_row").over(along))
    carry = carry.select("_part", *keys, "_before", "_prev_row")

    here = Window.partitionBy("_part", *keys)
    totals = rows.withColumn("_in", F.sum(measure).over(here.orderBy(order_by)))
    if previous:
        totals = totals.withColumn("_lag", F.lag(F.struct(measure)).over(here.orderBy("_no")))
    joined = _carried(totals, carry, keys)
    joined = _same(joined, more, [("_part", "_x_part"), *[(k, f"_x_{k}") for k in keys], (order_by, "_x_value")], "left")
    # A sum over NULLs alone is NULL; any addend makes it a sum.
    parts = [F.col("_in"), F.col("_before"), F.col("_more")]
    zero = F.lit(0).cast(kind)
    total = sum((F.coalesce(p, zero) for p in parts[1:]), F.coalesce(parts[0], zero))
    result = joined.withColumn(out, F.when(F.coalesce(*parts).isNotNull(), total).cast(kind))
    if previous:
        result = result.withColumn(previous, F.coalesce(F.col("_lag"), F.col("_prev_row")).getField(measure))
    return result.select(*df.columns, out, *([previous] if previous else []))


def rank(df: DataFrame, keys: Sequence[str], order_col: str, out: str, descending: bool = True, ranges: int | None = None) -> DataFrame:
    """``rank()`` (with gaps) per key, as ``with_rank``: NULL measures come last in both directions."""
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    rows = _placed(df, keys, [order], ranges)
    inside = Window.partitionBy("_part", *keys)
    marked = rows.withColumn("_first", F.min_by(F.struct(order_col), "_no").over(inside)).withColumn("_last", F.max_by(F.struct(order_col), "_no").over(inside))
    mine = F.struct(F.col(order_col))
    table = _spanning(
        marked, keys, F.count(F.lit(1)).alias("_n"), F.first("_first").alias("_first"), F.first("_last").alias("_last"),
        F.count_if(F.col("_first").eqNullSafe(mine)).alias("_n_first"), F.count_if(F.col("_last").eqNullSafe(mine)).alias("_n_last"),
    )
    value_rows = table.select(*keys, "_part", F.col("_first").alias("_value"), F.col("_n_first").alias("_c")).unionByName(
        table.where(~F.col("_first").eqNullSafe(F.col("_last"))).select(*keys, "_part", F.col("_last").alias("_value"), F.col("_n_last").alias("_c")))
    # Peers in earlier ranges: counted as rows before, but they share the rank.
    before_value = Window.partitionBy(*keys, "_value").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    peers = value_rows.withColumn("_peers", F.sum("_c").over(before_value)).where("_peers IS NOT NULL").select(
        F.col("_part").alias("_x_part"), *[F.col(k).alias(f"_x_{k}") for k in keys], F.col("_value").alias("_x_value"), "_peers")
    along = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = table.withColumn("_before", F.sum("_n").over(along)).select("_part", *keys, "_before")
    ranked = rows.withColumn("_in", F.rank().over(Window.partitionBy("_part", *keys).orderBy(order))).withColumn("_mine", F.struct(order_col))
    joined = _carried(ranked, carry, keys)
    joined = _same(joined, peers, [("_part", "_x_part"), *[(k, f"_x_{k}") for k in keys], ("_mine", "_x_value")], "left")
    place = F.col("_in") + F.coalesce("_before", F.lit(0)) - F.coalesce("_peers", F.lit(0))
    return joined.withColumn(out, place.cast("bigint")).select(*df.columns, out)


def top_n(df: DataFrame, keys: Sequence[str], order_col: str, n: int, rank_col: str = "rank_in_group", descending: bool = True, ranges: int | None = None) -> DataFrame:
    """Rows whose rank is at most ``n`` (ties included).

    Candidates are found in parts of each key (a row of the top n of its key is one of the top n of its
    part), so only those are ranked over the whole key.
    """
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)))
    part = F.rank().over(Window.partitionBy(*keys, "_salt").orderBy(order))
    candidates = salted.withColumn("_rank", part).where(F.col("_rank") <= n).drop("_salt", "_rank")
    return rank(candidates, keys, order_col, rank_col, descending, ranges).where(F.col(rank_col) <= n)
