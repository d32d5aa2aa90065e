"""Exact duplicates by 128-bit content hash, with the bytes compared inside every group.

Rows are grouped by two independent 64-bit hashes of the text.  Grouping is a
narrow aggregate with map-side combine, so a text held by a third of all rows
costs one row per task.  Groups of two or more rows are then checked: the least
and the greatest text of the group must be the same bytes.  Should a group ever
hold different texts (a collision), it is split by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path


SALTS = 16


def content_hash(text: Column) -> tuple[Column, Column]:
    """128 bits of content hash as two longs."""
    return F.xxhash64(text), F.xxhash64(F.lit("second half"), text)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", hash_with=content_hash) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256``.

    ``keep`` names the surviving id of equal texts: ``"min"`` (smallest stable id) or ``"max"``.
    Null text counts as empty.  Null ids lose against any other; rows that repeat an id and a
    text form one group in which exactly one row is kept.  An empty table gives no rows; other
    columns of ``docs`` are not read.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be 'min' or 'max'")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h1, h2 = hash_with(text)
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), h1.alias("h1"), h2.alias("h2"))

    # The narrow table is written once: its row numbers must not change between its two readers.
    path = scratch_path(docs.sparkSession, "exact-dedup")
    rows.select("id", "h1", "h2", F.sha2("text", 256).alias("sha"), F.monotonically_increasing_id().alias("row")).write.parquet(path)
    narrow = docs.sparkSession.read.parquet(path)

    if keep == "min":
        best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    else:
        best = F.max(F.struct(F.col("id").isNotNull().alias("some"), "id", "row"))
    groups = narrow.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    # The texts of a group are compared in SALTS parts first, so a hot group is not one task.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>"))
    shared = groups.where("group_size > 1").select("h1", "h2", salts.alias("salt"))
    key = ["h1", "h2", "salt"]
    members = rows.select("h1", "h2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"), "text").join(shared, key, "left_semi")
    parts = members.groupBy(key).agg(F.min("text").alias("lo"), F.max("text").alias("hi"))
    collided = parts.groupBy("h1", "h2").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo != hi").select("h1", "h2")

    clean = narrow.join(collided, ["h1", "h2"], "left_anti").join(groups, ["h1", "h2"])
    # Rows of collided hashes are grouped by their digest instead (and again by 128 bits of another family).
    other = narrow.join(collided, ["h1", "h2"], "left_semi")
    by_text = other.groupBy("h1", "h2", "sha").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
    split = other.join(by_text, ["h1", "h2", "sha"])
    return clean.select(split.columns).unionByName(split).select(
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, **options) -> DataFrame:
    """The ids that survive ``exact_groups``."""
    return exact_groups(docs, **options).where("kept").select("id")
