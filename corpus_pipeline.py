"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept, and returns the columns of ``documents``; the last returns the packed pieces.
Stages are written as Parquet and read again, so a lost executor repeats a part of
one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from strata.llm.queries import TOKENIZER
from strata.session import ensure_checkpoint_dir, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that are not rejected."""
    failures = quality_rules.measure(docs.select("source", "text")).select(F.col("doc.source").alias("host"), quality_rules.base_failed().alias("failed"))
    verdicts = quality_rules.host_verdicts(failures, quality_rules.HOST_LIMIT)
    judged = quality_rules.judge(quality_rules.measure(docs, with_text=True), verdicts=verdicts)
    return judged.where("kept").select("doc.*", "text").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sources share, but for each line's first place."""
    cleaned = line_dedup.dedup_lines(docs).select("doc.*").withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar shingle sets: the smallest id, null ids last.

    Rows that share an id are told apart by a hash of the whole row; of equal rows with words one
    stays.  Texts without words are linked with nothing, so all of their rows stay.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(*docs.columns).alias("row"))
    keyed = docs.withColumn("_key", key)
    found = jaccard_join.jaccard_components(keyed, id_col="_key")
    kept = found.where(F.col("id") == F.col("component_id")).groupBy(F.col("id").alias("_key")).agg(F.count(F.lit(1)).alias("copies"), F.max("n_shingles").alias("n"))
    path = scratch_path(spark, "pipeline-kept")
    kept.select("_key", ((F.col("copies") > 1) & (F.col("n") > 0)).alias("several")).write.parquet(path)
    kept = spark.read.parquet(path)
    out = keyed.join(kept.where("NOT several"), "_key", "left_semi")
    equal = kept.where("several")
    if not equal.isEmpty():
        out = out.unionByName(keyed.join(equal, "_key", "left_semi").dropDuplicates(["_key"]))
    return out.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources meet their target weights."""
    mixed = mixing.mix_sources(docs.select(F.struct("*").alias("doc"), "doc_id", "source", "text"), carry=[F.col("doc")])
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in sequences of at most 1024 tokens."""
    packed = packing.pack_documents(docs, TOKENIZER, {"ids_crc32": F.crc32("ids")})
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality rules", quality), ("line dedup", lines), ("n-gram Jaccard join", near_duplicates), ("source mix", mix), ("best-fit packing", pack)]

# Token ids, shingle components and the genetic algorithm have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
