"""Session construction and shared-storage locations.

Intermediate tables (CSV drops, partitioned round trips, stream checkpoints)
must live on storage every executor can reach.  The cluster names that place in
``spark.checkpoint.dir``; we read it from the session and only fall back to a
local folder when it is unset (unit tests on ``local[*]``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; every one can be overridden by the caller.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Starting points for a large cluster (hundreds of executors, 100 TB inputs).
# Shuffles start wide and AQE coalesces them to the advisory size; skewed join
# partitions are split; scans read 256 MB splits.  Size executor memory so a
# 256 MB shuffle partition plus its sort buffer fits per core.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    profile: str = "default",
) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    ``profile="cluster"`` adds ``CLUSTER_CONF``; explicit ``conf`` wins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if profile == "cluster":
        settings.update(CLUSTER_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Resolution order: the ``spark.checkpoint.dir`` setting, then a directory
    already given to ``SparkContext.setCheckpointDir``, then, on a ``local``
    master only, a private folder under the system temp dir, registered as the
    context's checkpoint dir; on any other master an unset folder is an error.  The setting itself is a startup option and
    cannot be changed on a running session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        current = spark.sparkContext.getCheckpointDir()
    except NotImplementedError:  # Spark Connect: the server side owns the checkpoint settings
        current = None
    if current:
        return current.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):  # a cluster's executors don't share it
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    fallback = tempfile.mkdtemp(prefix="strata-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(fallback)
    except NotImplementedError as exc:  # a client-side folder is useless to a remote server
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the Spark server") from exc
    return fallback


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: point the context at the shared root."""
    root = checkpoint_root(spark)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
    except NotImplementedError:  # Spark Connect: nothing to set from the client
        pass
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "strata", f"{name}-{uuid.uuid4().hex}")
