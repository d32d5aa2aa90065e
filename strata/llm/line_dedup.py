"""Cross-site line deduplication by distinct-site spread.

A line is boilerplate when it occurs at ``min_sites`` or more distinct sites.
Sites are counted with one HyperLogLog sketch per line hash; sketches merge in
the aggregation, so a line that stands in a third of all documents is still one
small row per task.  Lines whose estimate is within ``band`` of the threshold are
counted exactly before the decision; by default that is a tenth of the threshold, six
standard errors of the sketch.

Boilerplate is not erased from the corpus: its first occurrence (smallest id,
then place in the text) stays, all others go.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

SALTS = 16
NEWLINE = "\n"
EDGE = " \t\r"
_W, _B = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"


def at_least_words(n: int) -> str:
    """Pattern of a text with ``n`` words or more."""
    return _B.join([_W] * n)


def _numbered_lines(rows: DataFrame, min_words: int) -> DataFrame:
    lines = rows.select("id", "key", "site", F.posexplode(F.split("text", NEWLINE)).alias("pos", "raw"))
    lines = lines.withColumn("line", F.trim("raw", F.lit(EDGE))).where(F.col("line").rlike(at_least_words(min_words)))
    return lines.select("id", "key", "site", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second half"), "line").alias("h2"))


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("none"), "id", "key", "pos")


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int, band: int) -> DataFrame:
    """``h1, h2, first`` of the lines at ``min_sites`` or more sites; ``first`` is the occurrence that stays."""
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"), F.min(_place()).alias("first"))
    spread = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") > min_sites - band)
    near = spread.where(F.col("sites") < min_sites + band)
    pairs = lines.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").select("h1", "h2", "site").distinct()
    exact = pairs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("h1", "h2")
    sure = spread.where(F.col("sites") >= min_sites + band)
    return sure.unionByName(near.join(exact, ["h1", "h2"], "left_semi")).select("h1", "h2", "first")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = 6,
                min_words: int = 1, lg_k: int = 12, band: int | None = None) -> DataFrame:
    """``doc`` (the input row, its text cleaned), ``n_lines``, ``n_removed``: one row per input row.

    Lines are compared without blanks at their ends; lines of fewer than ``min_words`` words (by
    default: blank lines) are never removed.  A null site is one site of its own.  A null text stays null
    and has no lines.  Rows that repeat id, site and text are one document: what goes from one goes
    from all.  An empty table gives no rows; other columns pass through inside ``doc``.
    """
    site = F.when(F.col(site_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(site_col).cast("string")))
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), site.alias("site"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(id_col), F.col(site_col), F.col(text_col)).alias("key"))
    path = scratch_path(docs.sparkSession, "line-places")
    _numbered_lines(rows, min_words).write.parquet(path)  # hashes and places only, read three times
    lines = docs.sparkSession.read.parquet(path)
    spread = boilerplate(lines, min_sites, lg_k, max(2, math.ceil(min_sites / 10)) if band is None else band)
    # A line that stands everywhere meets its verdict in SALTS tasks; verdicts are few, so they are copied.
    salted = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    doomed = lines.withColumn("salt", F.pmod(F.xxhash64("key", "pos"), F.lit(SALTS)).cast("int")).join(salted, ["h1", "h2", "salt"]).where(_place() != F.col("first"))
    gone = doomed.groupBy("id", "key").agg(F.collect_set("pos").alias("gone")).select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key"), "gone")

    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("key") == F.col("gone_key")), "left")
    parts = F.split("text", NEWLINE)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    cleaned = F.array_join(F.transform(left, lambda p: F.element_at(parts, p + 1)), NEWLINE)
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(cleaned)
    return joined.select(
        F.col("doc").withField(text_col, text).alias("doc"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
