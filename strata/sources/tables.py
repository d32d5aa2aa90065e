"""Parquet tables addressed by path: write with overwrite modes, read with
partition discovery, name them as views, run parameterised SQL over them."""

from __future__ import annotations

import datetime
import os
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

OVERWRITE_MODES = ("all", "partitions")
OPEN_FILES = 32  # partitions that a task writes side by side; it sorts only the rows of those beyond
REBALANCE_PARTITIONS = 200  # up to so many a task hands its rows on without holding them


@contextmanager
def _files_side_by_side(spark: SparkSession, n: int):
    """Tasks of the writes inside keep a file open per partition value instead of sorting their rows by it."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] | None = None,
    overwrite: str = "all",
    sort_by: Sequence | None = None,
    max_records_per_file: int | None = None,
    single_file: bool = False,
    rebalance: bool = False,
) -> None:
    """Write ``df`` as a (hive-partitioned) Parquet table.

    * ``overwrite="all"``: the whole table directory is replaced (static mode).
    * ``overwrite="partitions"``: only partitions present in ``df`` are
      replaced, all others are kept (dynamic partition overwrite), which makes
      per-year backfills idempotent.  A partition that becomes empty is not
      removed.

    No shuffle is added: every task writes the partitions it holds, a file
    open per value.  A hot partition value is therefore written by many tasks
    in parallel instead of by one, and rows are not held: a task may get very
    many, as its share of a table is by bytes and columns of few values take
    hardly any.  Only rows of values beyond the first ``OPEN_FILES`` of a task
    are sorted, and all its rows where ``sort_by`` asks for it.

    That is the right default when the input is already clustered by the
    partition column (a layer read from a table partitioned the same way).
    For an unclustered input, ``rebalance=True`` adds one ``REBALANCE``
    shuffle on the partition columns: AQE then splits a hot value over
    several tasks and merges small ones, so files approach the advisory size
    instead of one file per task and value.

    ``single_file`` (unpartitioned, year-grained outputs only: their size is
    bounded by the number of periods) sorts globally by ``sort_by`` and writes
    one file.
    """
    if overwrite not in OVERWRITE_MODES:
        raise ValueError(f"overwrite must be one of {OVERWRITE_MODES}")
    keys = list(partition_by or [])
    out = df
    order = keys + list(sort_by or [])
    if single_file:
        if keys:
            raise ValueError("single_file is for unpartitioned outputs")
        # One partition sorted in place: no range-sampling job, upstream stays parallel.
        out = out.repartition(1)
        if order:
            out = out.sortWithinPartitions(*order)
    else:
        if rebalance:
            parts = min(REBALANCE_PARTITIONS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            out = out.hint("rebalance", parts, *keys)
        if sort_by:
            out = out.sortWithinPartitions(*order)
    writer = out.write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic" if overwrite == "partitions" else "static"
    )
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if keys:
        writer = writer.partitionBy(*keys)
    with _files_side_by_side(df.sparkSession, 0 if sort_by else OPEN_FILES):
        writer.parquet(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table root; hive partition columns come back as columns.

    Pass ``schema`` to pin partition column types (otherwise '02' reads as 2).
    ``columns`` fixes the column order (partition columns are read last).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def write_ordered(df: DataFrame, path: str, order_by: Sequence, files: int | None = None) -> None:
    """Write ``df`` as files that follow one another in the order of ``order_by`` (ranges, each sorted).

    Rows that tie are spread too, so no order value makes a file of its own.  ``read_ordered`` hands
    the rows back in this order.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*order_by, F.col("_row")]
    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(n, *by).sortWithinPartitions(*by)
    dealt.drop("_row").write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "_position") -> DataFrame:
    """The rows of ``write_ordered`` with their place in the order, from 0.

    The place is the file's first one (from the files' row counts, a row per file) plus the row's index
    in its file, so it is the same however the files are split.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_index"))
    number = F.regexp_extract("_file", "part-([0-9]+)", 1).cast("int")
    counts = rows.groupBy("_file", number.alias("_no")).agg((F.max("_index") + 1).alias("n")).orderBy("_no").collect()
    starts, at = [], 0
    for row in counts:
        starts.append((row["_file"], at))
        at += row["n"]
    placed = rows.join(spark.createDataFrame(starts, "_file string, _start long"), "_file")
    return placed.withColumn(position, F.col("_start") + F.col("_index")).drop("_file", "_index", "_start")


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> list[str]:
    """Name each table (a DataFrame or a Parquet path) as a temporary view."""
    names = []
    for name, src in tables.items():
        df = spark.read.parquet(src) if isinstance(src, str) else src
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def create_path_view(spark: SparkSession, name: str, path: str) -> None:
    """A view defined over a Parquet path (re-reads the files at every use)."""
    quoted = path.replace("`", "``")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW IDENTIFIER(:name) AS SELECT * FROM parquet.`{quoted}`",
        args={"name": name},
    )


def sql_text(spark: SparkSession, source: str | os.PathLike) -> str:
    """The text of a SQL stage: a path object names a file (read through Spark, from any store), a string is the text."""
    if isinstance(source, os.PathLike):
        source = spark.read.option("wholetext", True).text(os.fspath(source)).first().value
    if not source.strip():
        raise ValueError("the SQL text is empty")
    return source


def run_sql(
    spark: SparkSession,
    sql: str | os.PathLike,
    args: Mapping[str, object] | None = None,
    frames: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """A parameterised SQL stage.

    Values are bound with named parameter markers (``:year``) and table names
    with ``IDENTIFIER(:tbl)``: nothing is spliced into the text.  ``frames``
    are DataFrames referenced as ``{name}`` in the text.
    """
    return spark.sql(sql_text(spark, sql), args=dict(args or {}), **dict(frames or {}))


def with_audit(df: DataFrame, column: str, enabled: bool | datetime.datetime = True) -> DataFrame:
    """Audit timestamp (one value per query).  Disabled, or given as a fixed time, for reproducible outputs."""
    if isinstance(enabled, datetime.datetime):
        return df.withColumn(column, F.lit(enabled))
    return df.withColumn(column, F.current_timestamp()) if enabled else df
