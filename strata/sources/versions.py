"""Tables whose contents change in one step, and a catalogue of views that outlives the session.

A versioned table keeps every write in a folder of its own (``data/__write=...``).  A manifest, a small file
under ``_versions``, names the folders that make up a version; the table changes when the next manifest
appears, and not before.  A job that dies leaves a folder that no manifest names: readers never see it.
A write of some partitions takes the other ones over from the version before, without copying them.
Readers work on the version they began with; ``vacuum`` removes what older versions alone need.

One writer at a time is expected; of two that commit the same version, the one that comes second is told.

The catalogue is such a list of manifests too: view names, the table each stands for, and its schema.
Any session can attach them, in this process or another.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.sources import stores
from strata.sources.tables import write_table

MANIFESTS = "_versions"
WRITE = "__write"  # key of the folder that a write goes to
CATALOGUE = "_catalogue"


class CommitConflict(RuntimeError):
    """Another writer has committed the same version."""


# --- manifests ----------------------------------------------------------------------------------


def _numbers(folder: str) -> list[int]:
    return sorted(int(n[:-5]) for n, is_folder in stores.names(folder) if not is_folder and n.endswith(".json") and n[:-5].isdigit())


def _manifest(folder: str, number: int) -> dict:
    return json.loads(stores.read_bytes(f"{folder}/{number}.json"))


def _latest(folder: str) -> dict | None:
    found = _numbers(folder)
    return _manifest(folder, found[-1]) if found else None


def _commit(folder: str, before: dict | None, content: dict) -> int:
    """The next manifest; nothing of it can be seen before it is whole."""
    number = (before["version"] if before else 0) + 1
    mine = {"version": number, "writer": uuid.uuid4().hex, **content}
    if number in _numbers(folder):
        raise CommitConflict(f"version {number} of {folder} is there already")
    stores.put_bytes(f"{folder}/{number}.json", json.dumps(mine).encode())
    if _manifest(folder, number)["writer"] != mine["writer"]:
        raise CommitConflict(f"version {number} of {folder} was committed by another writer")
    return number


# --- tables -------------------------------------------------------------------------------------


def is_versioned(spark: SparkSession, path: str) -> bool:
    """Whether a table root has committed versions."""
    return bool(_numbers(f"{stores.qualified(spark, path)}/{MANIFESTS}"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be read, oldest first."""
    return _numbers(f"{stores.qualified(spark, path)}/{MANIFESTS}")


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] | None = None, overwrite: str = "all", drop: Sequence[str] = (), **options) -> int:
    """Write ``df`` as the table's next version; returns its number.

    ``overwrite="partitions"`` replaces the partitions that ``df`` holds and keeps all others as they
    are in the version before, but for those in ``drop`` (``year=2020``), which end unless ``df`` holds them.  ``options`` are those of ``write_table``.
    """
    if overwrite not in ("all", "partitions"):
        raise ValueError("overwrite must be 'all' or 'partitions'")
    keys = list(partition_by or [])
    if overwrite == "partitions" and not keys:
        raise ValueError("only a partitioned table can keep partitions")
    root = stores.qualified(df.sparkSession, path)
    before = _latest(f"{root}/{MANIFESTS}")
    if overwrite == "partitions" and before and before["partition_by"] != keys:
        raise ValueError(f"the table is partitioned by {before['partition_by']}, not {keys}")
    folder = f"{WRITE}=w{uuid.uuid4().hex}"
    write_table(df, f"{root}/data/{folder}", keys, **options)
    files = [n for n, is_folder in stores.names(f"{root}/data/{folder}", recursive=True) if not is_folder and n.endswith(".parquet")]
    parts = {n.rpartition("/")[0]: folder for n in files}
    if overwrite == "partitions" and before:
        parts = {p: f for p, f in before["parts"].items() if p not in drop} | parts
    # Partition columns come last when a table is read.
    schema = StructType([f for f in df.schema if f.name not in keys] + [df.schema[k] for k in keys])
    return _commit(f"{root}/{MANIFESTS}", before, {"partition_by": keys, "schema": schema.jsonValue(), "parts": parts})


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table as of a version (by default the latest); later commits don't change what the frame reads."""
    root = stores.qualified(spark, path)
    manifest = _latest(f"{root}/{MANIFESTS}") if version is None else _manifest(f"{root}/{MANIFESTS}", version)
    if manifest is None:
        raise FileNotFoundError(f"{path} has no version")
    schema = StructType.fromJson(manifest["schema"])
    if not manifest["parts"]:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/data/{folder}/{part}".rstrip("/") for part, folder in manifest["parts"].items()]
    whole = StructType(list(schema)).add(WRITE, "string")
    frame = spark.read.option("basePath", f"{root}/data").schema(whole).parquet(*map(_literal, folders))
    return frame.select(*[f"`{c}`" for c in schema.names])


def _literal(path: str) -> str:
    """A path without pattern characters of its own."""
    return "".join("\\" + c if c in "\\{}[]*?" else c for c in path)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forget all but the last ``keep`` versions and remove the folders that none of those needs; returns these.

    Folders of dead jobs go too, so no write may be under way.
    """
    if keep < 1:
        raise ValueError("the latest version stays")
    root = stores.qualified(spark, path)
    found = _numbers(f"{root}/{MANIFESTS}")
    kept = [_manifest(f"{root}/{MANIFESTS}", n) for n in found[-keep:]]
    needed = {folder for m in kept for folder in m["parts"].values()}
    for number in found[:-keep]:
        stores.remove_file(f"{root}/{MANIFESTS}/{number}.json")
    gone = [n for n, is_folder in stores.names(f"{root}/data") if is_folder and n not in needed]
    for name in gone:
        stores.remove_folder(f"{root}/data/{name}")
    return gone


# --- views --------------------------------------------------------------------------------------


def publish_views(spark: SparkSession, root: str, tables: Mapping[str, tuple[str, DataFrame]]) -> list[str]:
    """Record views (name -> path of a table, and a frame with its schema) under the lake root, and name them here.

    The catalogue keeps what it had; a name that is published again stands for its new table.  A view of
    a versioned table shows, wherever it is attached, the version that is the latest then.
    """
    folder = f"{stores.qualified(spark, root)}/{CATALOGUE}"
    before = _latest(folder)
    entries = {name: {"path": stores.qualified(spark, path), "schema": df.schema.jsonValue()} for name, (path, df) in tables.items()}
    _commit(folder, before, {"views": (before["views"] if before else {}) | entries})
    for name, (_, df) in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def catalogue(spark: SparkSession, root: str) -> dict[str, dict]:
    """name -> path and schema of the views that have been published under a lake root."""
    found = _latest(f"{stores.qualified(spark, root)}/{CATALOGUE}")
    return found["views"] if found else {}


def attach_views(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> list[str]:
    """Name the published views in this session, as they were published; returns their names."""
    known = catalogue(spark, root)
    missing = set(names or ()) - set(known)
    if missing:
        raise KeyError(f"no view {', '.join(sorted(missing))} under {root}")
    for name in names or known:
        path, schema = known[name]["path"], StructType.fromJson(known[name]["schema"])
        df = read_version(spark, path) if is_versioned(spark, path) else spark.read.schema(schema).parquet(_literal(path))
        df.createOrReplaceTempView(name)
    return list(names or known)
