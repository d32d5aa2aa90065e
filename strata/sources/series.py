"""Array-per-key series -> (key, period, value) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_series(
    df: DataFrame,
    keys: Sequence[str],
    values_col: str,
    base_col_or_year,
    period: str = "year",
    value: str = "value",
) -> DataFrame:
    """``posexplode`` a values array; the period is ``base + position``.

    ``base_col_or_year`` is a column name or a fixed first period.  Each array
    is one key's series (bounded by the number of periods).
    """
    base = F.col(base_col_or_year) if isinstance(base_col_or_year, str) else F.lit(base_col_or_year)
    exploded = df.select(*keys, base.alias("_base"), F.posexplode(values_col).alias("_pos", value))
    return exploded.select(*keys, (F.col("_base") + F.col("_pos")).cast("bigint").alias(period), value)
