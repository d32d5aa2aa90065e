"""Mixing sources to target weights by systematic sampling.

Every document of a source expects ``target / source_size`` copies.  Documents
are put in order inside their source, expected copies are prefix-summed, one
offset per source is added, and a copy is emitted for every integer boundary a
document's interval crosses.  Ordering by size makes the words taken, not only
the copies, follow the target closely.

The prefix sum is distributed: rows are range-partitioned by (source, size, id),
so a hot source or a frequent size spans many partitions; each partition counts
its rows per source, the counts are prefix-summed (a table of partitions, not of
rows) and added to the local row numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``: non-blanks that open a word (null: 0)."""
    blank = "\t\n\x0b\x0c\r"
    flat = F.translate(F.coalesce(text, F.lit("")), blank, " " * len(blank))
    return F.size(F.filter(F.split(flat, " "), lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources in code-point order (null last) take the weights in turn.  A target is the smaller of
    ``max_repeat * source_size`` and ``level * weight``; the level is the one at which all targets
    add up to the total size, which is where re-sharing the excess by weight comes to rest.
    The table has one row per source, so its windows run over sources, never over documents.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    ranked = sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % n + 1).cast("int")))
    ranked = ranked.withColumn("_cap", F.col("source_size").cast("double") * max_repeat)
    fill = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    upto, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    every = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(every)
    # If all sources before this one stop at their caps, the others share what is left at this level.  It is
    # reached at the first source whose cap it doesn't pass; beyond that one the values only fall.
    level = (total - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("_weight").over(rest)
    leveled = ranked.withColumn("_level", F.when(level * F.col("_weight") <= F.col("_cap"), level))
    return leveled.withColumn("_found", F.max("_level").over(every)).select(
        "source", "source_size", F.least(F.col("_cap"), F.col("_found") * F.col("_weight")).alias("target")
    )


def mix_sources(docs: DataFrame, source_col: str = "source", size: Column | None = None, order_col: str = "doc_id", carry: list | None = None,
                weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = 7) -> DataFrame:
    """Documents with ``size, source_size, target, copies``; a copy count of 0 leaves the document out of the mix.

    ``carry`` are columns to hand through (default: ``order_col``); their names must differ from the four
    outputs', so rows with such columns are carried as one struct.  Null source is a source of its
    own, null or blank text has size 0.  Reruns agree: the order is (size, id) and the offset comes
    from a hash of the source and the seed; rows that repeat id and size are interchangeable.  A
    source whose texts are all empty has target 0.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    size = word_count(F.col("text")) if size is None else size
    carry = [F.col(order_col)] if carry is None else carry
    rows = docs.select(F.struct(*carry).alias("_row"), F.col(source_col).alias("_source"), size.alias("_size"), F.col(order_col).alias("_id"))
    key = [F.col("_source").isNull(), F.col("_source"), F.col("_size"), F.col("_id").isNull(), F.col("_id")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "mixing")
    # Written once, so the row numbers (partition << 33 | place in the sorted partition) are fixed for both readers.
    ordered = rows.repartitionByRange(n, *key).sortWithinPartitions(*key).withColumn("_no", F.monotonically_increasing_id())
    ordered.withColumn("_part", F.shiftright("_no", 33)).write.parquet(path)
    rows = spark.read.parquet(path)

    per_part = rows.groupBy("_source", "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"), F.min("_no").alias("_first"))
    earlier = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    sizes = per_part.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"))
    targets = source_targets(sizes, weights, max_repeat)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("source"), F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    plan = offsets.join(targets, F.col("_source").eqNullSafe(F.col("source"))).select(
        F.col("_source").alias("_s"), F.col("_part").alias("_p"), (F.col("_before") - F.col("_first")).alias("_shift"), "source_size", "target",
        start.alias("_start"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)).alias("_rate"),
    )
    # One row per partition and source in it; as a table of known size it is broadcast only if Spark's threshold allows.
    plan_path = scratch_path(spark, "mixing-plan")
    plan.coalesce(1).write.parquet(plan_path)
    plan = spark.read.parquet(plan_path)
    placed = rows.join(plan, (F.col("_part") == F.col("_p")) & F.col("_source").eqNullSafe(F.col("_s")))
    k = (F.col("_no") + F.col("_shift")).cast("double")  # place in the source, from 0
    copies = F.floor(F.col("_start") + (k + 1) * F.col("_rate")) - F.floor(F.col("_start") + k * F.col("_rate"))
    return placed.select("_row.*", F.col("_size").alias("size"), "source_size", "target", copies.alias("copies"))
