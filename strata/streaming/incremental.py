"""Incremental ingestion and change detection.

"Run only when the source changed" becomes Structured Streaming over a
landing folder: the file source remembers which files it has processed in
its checkpoint, ``trigger(availableNow=True)`` processes everything new and
stops, and a rerun with no new files does nothing.  The checkpoint commits
only after the batch has been written, so a failed run is retried on the next
schedule instead of being skipped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sources.stores import open_stream


def _reader(spark: SparkSession, schema: StructType, fmt: str, options: dict | None):
    r = spark.readStream.schema(schema).format(fmt)
    # CSV: every file's header is checked against the schema instead of being mapped by position; quotes as in read_csv.
    opts = {"header": "true", "enforceSchema": "false", "escape": '"', "multiLine": "true"} if fmt == "csv" else {}
    opts.update(options or {})
    for k, v in opts.items():
        r = r.option(k, v)
    return r


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "csv",
    options: dict | None = None,
    max_files_per_trigger: int | None = None,
) -> None:
    """Append rows of files not seen before to a Parquet table, then stop.

    Uses the file sink, which is exactly-once: its ``_spark_metadata`` log
    lists only committed files, so readers of ``target`` never see a partial
    or replayed batch.  ``landing`` may be a glob (``landing/*``).
    """
    opts = dict(options or {})
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    stream = _reader(spark, schema, fmt, opts).load(landing)
    if transform is not None:
        stream = transform(stream)
    writer = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()


def process_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    checkpoint: str,
    batch_fn: Callable[[DataFrame, int], None],
    fmt: str = "csv",
    options: dict | None = None,
    columns: Sequence | None = None,
) -> None:
    """Run ``batch_fn(new_rows, batch_id)`` over files not seen before, then stop.

    ``batch_fn`` must be idempotent per ``batch_id`` (a batch is replayed if
    the run dies before the checkpoint commits), e.g. a dynamic-partition
    overwrite of the years present in the batch.
    """
    stream = _reader(spark, schema, fmt, options).load(landing)
    if columns is not None:
        stream = stream.select(*columns)
    (
        stream.writeStream.foreachBatch(batch_fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def new_files(spark: SparkSession, landing: str, checkpoint: str, batch_fn: Callable[[DataFrame, int], None], max_files_per_batch: int | None = None) -> None:
    """Run ``batch_fn(files, batch_id)`` over files not seen before (``path, length, modified, file_path``), then stop.

    Only the listing is read, not the files.  ``batch_fn`` must be idempotent per ``batch_id``.
    """
    schema = StructType.fromDDL("path string, modificationTime timestamp, length bigint, content binary")
    options = {"maxFilesPerTrigger": str(int(max_files_per_batch))} if max_files_per_batch else {}
    listed = ["path", "length", F.col("modificationTime").alias("modified"), F.col("_metadata.file_path").alias("file_path")]
    process_new_files(spark, landing, schema, checkpoint, batch_fn, fmt="binaryFile", options=options, columns=listed)


PIECE_BYTES = 8 << 20


def _digests(batches):
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with open_stream(path) as f:
                while piece := f.read(PIECE_BYTES):
                    digest.update(piece)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "digest"])


def file_state(spark: SparkSession, landing: str) -> DataFrame:
    """``path, length, modified, digest`` of every file under ``landing`` (a folder or a glob).

    ``digest`` is the SHA-256 of the content, streamed in pieces by the task that lists the file, from a
    store that ``pyarrow.fs`` knows (any other is an error).  Spark doesn't list empty files.
    """
    listed = spark.read.format("binaryFile").load(landing).select("path", "length", F.col("modificationTime").alias("modified"))
    return digests(listed)


def digests(files: DataFrame) -> DataFrame:
    """Adds ``digest``, the SHA-256 of the content, to a frame of files (``path`` and any other columns)."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    return files.mapInArrow(_digests, f"{kept}, digest string")


def changed_files(state: DataFrame, before: DataFrame | None) -> DataFrame:
    """``path, change``: files ``added``, ``changed`` or ``removed`` since an earlier ``file_state``.

    A file published again under its name is changed when its content is; a touched file with the same
    content is not.  A file whose earlier state has no digest counts as changed.
    """
    if before is None:
        return state.select("path", F.lit("added").alias("change"))
    old = before.select("path", F.col("digest").alias("_digest"), F.lit(True).alias("_known"))
    both = state.withColumn("_here", F.lit(True)).join(old, "path", "full_outer")
    same = F.coalesce(F.col("digest") == F.col("_digest"), F.lit(False))
    change = F.when(F.col("_known").isNull(), "added").when(F.col("_here").isNull(), "removed").when(~same, "changed")
    return both.select("path", change.alias("change")).where("change IS NOT NULL")


def row_fingerprint(df: DataFrame, columns: Sequence[str]) -> F.Column:
    """128-bit fingerprint of the row's values as two 64-bit hashes.

    The typed columns are hashed themselves, at their full precision (timestamps
    to the microsecond), with a NULL flag each, since the hash skips NULLs.
    Fixed-width longs keep the diff aggregate a hash aggregate (string maxima
    would force a sort-based one).
    """
    values = [v for c in columns for v in (F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(*values).alias("h1"), F.xxhash64(F.lit("#"), *values).alias("h2"))


def diff_snapshots(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Per key: ``added``, ``removed``, ``changed`` or ``unchanged`` between two snapshots.

    Both sides are reduced to (key, fingerprint), tagged and unioned, then
    grouped by key: one shuffle of narrow rows with a map-side partial
    aggregate, instead of a full outer join of the wide tables.  Keys are
    expected to be unique within each snapshot.
    """
    cols = list(columns or [c for c in old.columns if c not in keys])

    def side(df: DataFrame, tag: int) -> DataFrame:
        fp = row_fingerprint(df, cols)
        return df.select(*keys, F.lit(tag).alias("_side"), fp.getField("h1").alias("_h1"), fp.getField("h2").alias("_h2"))

    g = side(old, 1).unionByName(side(new, 2)).groupBy(*keys).agg(
        F.max(F.when(F.col("_side") == 1, F.col("_h1"))).alias("_o1"),
        F.max(F.when(F.col("_side") == 1, F.col("_h2"))).alias("_o2"),
        F.max(F.when(F.col("_side") == 2, F.col("_h1"))).alias("_n1"),
        F.max(F.when(F.col("_side") == 2, F.col("_h2"))).alias("_n2"),
        F.max(F.when(F.col("_side") == 1, F.lit(1))).alias("_in_old"),
        F.max(F.when(F.col("_side") == 2, F.lit(1))).alias("_in_new"),
    )
    same = (F.col("_o1") == F.col("_n1")) & (F.col("_o2") == F.col("_n2"))
    change = (
        F.when(F.col("_in_old").isNull(), F.lit("added"))
        .when(F.col("_in_new").isNull(), F.lit("removed"))
        .when(same, F.lit("unchanged"))
        .otherwise(F.lit("changed"))
    )
    return g.select(*keys, change.alias("change_type"))
