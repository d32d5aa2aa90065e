"""Sharding by extendible hashing.

A directory is indexed by the leading bits of each document's hash.  A bucket
holds all documents that share its prefix; only buckets over the byte limit are
split on one more bit, until every shard fits.

The splits are worked out on byte counts, not on documents: one aggregate gives
the bytes under every prefix of the directory's depth, the sizes of all shorter
prefixes follow from it, and each directory entry points at its shortest prefix
that fits.  Entries that are still too large at that depth go to another round
with a deeper directory, with their documents only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

BITS = 128


def hash_bits(key: Column) -> Column:
    """128 hash bits of a key as a string of 0 and 1 (null hashes like the empty text)."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.concat(*(F.lpad(F.conv(F.substring(digest, 1 + 16 * i, 16), 16, 2), 64, "0") for i in range(2)))


def _split(entries: DataFrame, deepest: int, limit: int) -> DataFrame:
    """``prefix`` (at the deepest level) -> ``shard, shard_bytes``; without the entries that are too large even there.

    Sizes of all levels are one aggregate.  A shard is a prefix that fits under a parent that doesn't;
    entries are then joined at the depths that shards have, never at the short prefixes that all share.
    """
    spark = entries.sparkSession
    path = scratch_path(spark, "sharding-levels")
    levels = entries.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(deepest))))
    levels.groupBy("d", F.expr("substring(prefix, 1, d)").alias("head")).agg(F.sum("bytes").alias("size")).write.parquet(path)
    sizes = spark.read.parquet(path)
    parents = sizes.where(F.col("size") > limit).select((F.col("d") + 1).alias("d"), F.col("head").alias("above"))
    below = sizes.where(F.col("size") <= limit).withColumn("above", F.expr("substring(head, 1, d - 1)"))
    leaves = below.where("d > 0").join(parents, ["d", "above"], "left_semi").unionByName(below.where("d = 0")).select("d", "head", "size")
    lo, hi = leaves.agg(F.min("d"), F.max("d")).first()
    if lo is None:  # nothing fits at any depth
        return entries.limit(0).select("prefix", F.lit("").alias("shard"), F.lit(0).cast("long").alias("shard_bytes"))
    placed = entries.withColumn("d", F.explode(F.sequence(F.lit(lo), F.lit(hi)))).withColumn("head", F.expr("substring(prefix, 1, d)"))
    return placed.join(leaves, ["d", "head"]).select("prefix", F.col("head").alias("shard"), F.col("size").alias("shard_bytes"))


def shard_documents(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text", step: int = 8, row_col: str | None = None) -> DataFrame:
    """One row per document: ``id, n_bytes, shard, depth, shard_bytes``, and ``row`` if ``row_col`` numbers the rows.

    ``shard`` is the hash prefix of the shard, its length the shard's local depth; the empty prefix
    is the whole table.  ``n_bytes`` counts the text's UTF-8 bytes (null: 0).  Documents that share
    an id share the hash; a further 128 bits of their row number part them, so the limit holds for
    repeated ids too.  One text over the limit gets a shard of its own, at the full depth.  An empty
    table gives no rows; other columns are not read.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    spark = docs.sparkSession
    size = F.octet_length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long")
    path = scratch_path(spark, "sharding")
    docs.select(F.col(id_col).alias("id"), size.alias("n_bytes"), (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row")).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("bits", F.concat(hash_bits(F.col("id")), hash_bits(F.col("row"))))

    # A text over the limit can share with nobody: a shard of its own, at the full depth.
    out = rows.where(F.col("n_bytes") > limit).withColumn("shard", F.col("bits")).withColumn("shard_bytes", F.col("n_bytes"))
    left = rows.where(F.col("n_bytes") <= limit)
    total = left.agg(F.sum("n_bytes")).first()[0] or 0
    depth = max(0, math.ceil(math.log2(max(1, total / limit)))) + step
    while True:
        keyed = left.withColumn("prefix", F.substring("bits", 1, depth))
        directory_path = scratch_path(spark, "sharding-directory")
        keyed.groupBy("prefix").agg(F.sum("n_bytes").alias("bytes")).write.parquet(directory_path)
        entries = spark.read.parquet(directory_path)
        out = out.unionByName(keyed.join(_split(entries, depth, limit), "prefix").drop("prefix"))
        large = entries.where(F.col("bytes") > limit).select("prefix")
        if large.isEmpty():
            break
        rest_path = scratch_path(spark, "sharding-rest")
        keyed.join(large, "prefix", "left_semi").drop("prefix").write.parquet(rest_path)
        left = spark.read.parquet(rest_path)
        depth = min(depth + (2 * step if depth < 64 else BITS), 2 * BITS)  # at the full depth every row is apart
    return out.select("id", "n_bytes", "shard", F.length("shard").cast("long").alias("depth"), "shard_bytes", *(["row"] if row_col else []))


def write_shards(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as one folder (``_shard=s<prefix>``) per shard of at most ``limit`` bytes of text; a shard fits one task by construction.

    Rows are numbered and written first, and joined to their shards by number, so rows with null or
    repeated ids are all written, each into its own shard.
    """
    spark = docs.sparkSession
    numbered = scratch_path(spark, "sharding-numbered")
    docs.withColumn("_row", F.monotonically_increasing_id()).write.parquet(numbered)
    docs = spark.read.parquet(numbered)
    shards = shard_documents(docs, limit, id_col, text_col, row_col="_row").select(F.col("row").alias("_row"), F.concat(F.lit("s"), "shard").alias("_shard"))
    placed = docs.join(shards, "_row").drop("_row")
    placed.repartition("_shard").write.partitionBy("_shard").parquet(path)
