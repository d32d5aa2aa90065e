"""Files of any store that ``pyarrow.fs`` knows, opened by the path under which Spark lists them."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme and folder that Spark resolves it to (``lake`` -> ``file:/home/me/lake``)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()


def _located(path: str):
    from pyarrow import fs

    scheme, authority, rest = re.fullmatch(r"(?:([\w+.-]+):)?(?://([^/]*))?(/.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), rest
    store, base = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority or ''}/")
    return store, base.rstrip("/") + rest


def open_stream(path: str):
    """A file for reading from its start, in pieces."""
    store, rest = _located(path)
    return store.open_input_stream(rest, compression=None)


def open_random(path: str):
    """A file for reading at any place."""
    store, rest = _located(path)
    return store.open_input_file(rest)


def read_bytes(path: str) -> bytes:
    """A whole (small) file."""
    with open_stream(path) as src:
        return src.read()


def put_bytes(path: str, data: bytes) -> None:
    """A small file, visible under its name only once it is whole."""
    store, rest = _located(path)
    folder = rest.rsplit("/", 1)[0]
    store.create_dir(folder, recursive=True)
    work = f"{folder}/.{uuid.uuid4().hex}"
    with store.open_output_stream(work, compression=None) as out:
        out.write(data)
    store.move(work, rest)


def names(path: str, recursive: bool = False) -> list[tuple[str, bool]]:
    """(path below ``path``, is a folder) of what lies in a folder; nothing for a folder that isn't there."""
    from pyarrow import fs

    store, rest = _located(path.rstrip("/"))
    found = store.get_file_info(fs.FileSelector(rest, recursive=recursive, allow_not_found=True))
    return sorted((f.path[len(rest) + 1 :], f.type == fs.FileType.Directory) for f in found)


def remove_folder(path: str) -> None:
    """A folder with all that it holds."""
    store, rest = _located(path)
    store.delete_dir(rest)


def remove_file(path: str) -> None:
    """One file."""
    store, rest = _located(path)
    store.delete_file(rest)


def move_file(source: str, target: str) -> None:
    """Give a file another name in the same store."""
    store, rest = _located(target)
    store.create_dir(rest.rsplit("/", 1)[0], recursive=True)
    store.move(_located(source)[1], rest)
