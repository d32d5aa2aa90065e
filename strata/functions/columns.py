"""Small column helpers shared by the other modules."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def year_of(c) -> Column:
    """Calendar year as BIGINT (Spark's ``year`` is INT; SQL engines often give BIGINT)."""
    return F.year(as_col(c)).cast("bigint")


def year_range(ts_col: str, first_year: int, last_year: int) -> Column:
    """``year(ts) BETWEEN a AND b`` written as a timestamp range.

    The range form reaches the Parquet reader as pushed filters (row-group
    skipping); ``year(ts)`` itself is not pushable.
    """
    c = F.col(ts_col)
    # Date literals coerce to the column's own timestamp type (NTZ or LTZ).
    return (c >= F.lit(datetime.date(first_year, 1, 1))) & (c < F.lit(datetime.date(last_year + 1, 1, 1)))


def blank_to_null(c) -> Column:
    """Treat empty (or all-blank) strings as missing, like Python's ``x or y``."""
    col = as_col(c)
    return F.when(F.trim(col) == F.lit(""), F.lit(None).cast("string")).otherwise(col)


def strip_ws(c) -> Column:
    """Strip leading and trailing whitespace of any kind (tabs, newlines, spaces)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")
