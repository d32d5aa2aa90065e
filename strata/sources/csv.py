"""Delimited text sources and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.session import scratch_path
from strata.sources import stores


def string_schema(columns: Sequence[str]) -> StructType:
    """All-string schema: raw text is typed later with ``try_cast`` (no inference pass)."""
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    encoding: str = "UTF-8",
    corrupt_column: str | None = None,
    with_source: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """CSV scan with an explicit schema (or header-named all-string columns).

    Without a schema the header is read as names and every column as a string,
    which avoids ``inferSchema``'s extra pass.  A UTF-8 byte-order mark in the
    header is dropped by the reader.  With ``with_source`` each row carries the
    file it came from (``_source_file``).

    Quoted fields may hold the delimiter, doubled quotes and line breaks.  A
    quoted line break means that a file cannot be split, so one file is one
    task; for large files known to have none, ``multi_line=False`` makes them
    splittable.  With ``corrupt_column`` a record that has too few or too many
    fields keeps its text there.  A schema is held against each file's header
    by name; another order or other names are an error.
    """
    reader = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", not header)
        .option("mode", "PERMISSIVE")
        .option("inferSchema", False)
    )
    paths = paths if isinstance(paths, str) else list(paths)
    if schema is None and header and multi_line:
        # The header's names are taken by the line reader: the other one lists files by pattern, which
        # misses names with glob characters.  A header with a line break inside a name isn't supported.
        schema = string_schema(reader.option("multiLine", False).csv(paths).columns)
        reader = reader.option("multiLine", True)
    if schema is not None:
        if corrupt_column:
            if isinstance(schema, str):
                schema = f"{schema}, {corrupt_column} string"
            else:
                schema = StructType(list(schema.fields) + [StructField(corrupt_column, StringType(), True)])
            reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
        reader = reader.schema(schema)
    df = reader.csv(paths)
    if with_source:
        df = df.withColumn("_source_file", F.col("_metadata.file_path"))
    return df


def sniff_delimiter(
    spark: SparkSession, path: str, candidates: Sequence[str] = (";", ","), sample_chars: int = 2048
) -> str:
    """Pick the first candidate found in the first ``sample_chars`` of a file.

    A line has its line end at least, so the sample's lines are among the first
    ``sample_chars``; no line brings more than the sample to the driver.
    """
    lines = spark.read.text(path).limit(sample_chars).select(F.substring("value", 1, sample_chars)).collect()
    sample = "\n".join(r[0] for r in lines)[:sample_chars]
    return next((c for c in candidates if c in sample), candidates[-1])


def publish_csv(df: DataFrame, folder: str, name: str, key: str, parts: int) -> None:
    """Write ``df`` as the files ``folder/name-<part>.csv``, replacing what was published under that name.

    Rows are dealt by the hash of ``key`` and sorted inside a part, so the same rows give the same files
    again.  Tasks write the files; the driver only names them.
    """
    spark = df.sparkSession
    work, folder = stores.qualified(spark, scratch_path(spark, "publish")), stores.qualified(spark, folder)
    write_csv(df.repartition(parts, key).sortWithinPartitions(*df.columns), work)
    for old, is_folder in stores.names(folder):
        if not is_folder and re.fullmatch(rf"{re.escape(name)}-[0-9]+\.csv", old):
            stores.remove_file(f"{folder}/{old}")
    for part, _ in stores.names(work):
        if part.startswith("part-"):
            stores.move_file(f"{work}/{part}", f"{folder}/{name}-{part.split('-')[1]}.csv")


def write_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    header: bool = True,
    mode: str = "overwrite",
) -> None:
    """CSV with a header and a fixed field order (one file per task)."""
    out = df.select(*columns) if columns else df
    out.write.mode(mode).option("header", header).option("sep", sep).option("escape", '"').csv(path)
