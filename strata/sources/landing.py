"""Landing folders holding raw files of several layouts.

Raw drops of one source arrive with different delimiters and header names.
One CSV read over files of mixed layouts would apply the first file's header
to all of them.  Here each file's first bytes are read by tasks over the list of
files, and its delimiter and column names travel with its byte ranges
(``ranges.read_columns``): one scan, and one plan, for any number of layouts.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.ranges import CANDIDATES, file_heads, read_columns


def header_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """(file_path, header): the first record of every file under ``path``, without a byte-order mark."""
    return file_heads(spark, path, encoding=encoding).select("file_path", "header")


def group_layouts(
    spark: SparkSession, path: str | Sequence[str], candidates: Sequence[str] = CANDIDATES, encoding: str = "UTF-8"
) -> dict[tuple[str, str], list[str]]:
    """{(delimiter, header): [files]}, for a look at a folder; reads don't need it."""
    layouts: dict[tuple[str, str], list[str]] = defaultdict(list)
    for row in file_heads(spark, path, candidates, encoding).select("sep", "header", "file_path").collect():
        layouts[(row.sep, row.header)].append(literal_path(row.file_path))
    return dict(layouts)


def literal_path(uri: str) -> str:
    """A file's URI (as in ``_metadata.file_path``) as a path to read: decoded, glob characters escaped."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", unquote(uri))


def read_landing(
    spark: SparkSession,
    path: str | Sequence[str] | DataFrame,
    harmonise_fn: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    candidates: Sequence[str] = CANDIDATES,
    encoding: str = "UTF-8",
) -> tuple[DataFrame, DataFrame]:
    """Harmonised rows and rejected rows of every file under ``path``.

    ``harmonise_fn.columns`` are the raw header names that the function looks for.  Records with too few
    or too many fields are rejected as ``malformed``.  ``encoding`` is the files' text encoding (e.g.
    ``ISO-8859-1`` for legacy exports).
    """
    return harmonise_fn(read_columns(spark, path, harmonise_fn.columns, candidates, encoding, as_map=True))
