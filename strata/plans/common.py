"""Pieces shared by the domain jobs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import MONEY_LIMIT, round_half_away
from strata.functions.parse import FRACTIONAL, plain_double
from strata.operators.cleaning import split_valid
from strata.sources.harmonise import REASON


def typed_int(c: str) -> Column:
    """Text or number to INT as SQL casts do it: decimals round half to even; bad text is NULL."""
    return typed_long(c).try_cast("int")


def typed_long(c: str) -> Column:
    """Text or number to BIGINT as SQL casts do it; bad text is NULL.

    Whole numbers are read exactly; only text with a decimal part or an exponent goes through
    DOUBLE (rounded half to even).
    """
    text = F.col(c).cast("string")
    whole = F.regexp_extract(text, r"^ *([+-]?[0-9]+) *$", 1).try_cast("bigint")
    return F.coalesce(whole, F.bround(plain_double(text, FRACTIONAL), 0).try_cast("bigint"))


def typed_double(c: str) -> Column:
    """Text or number to DOUBLE; text that is no plain number, and NaN and infinities, are NULL."""
    return plain_double(F.col(c).cast("string"))


def _typed(name: str, kind: str) -> Column:
    if kind == "int":
        return typed_int(name)
    if kind == "bigint":
        return typed_long(name)
    if kind == "double":
        return typed_double(name)
    return F.col(name).cast("string")


CORRUPT = "_corrupt_record"


def type_columns(
    df: DataFrame, types: Mapping[str, str], keep: tuple[str, ...] = (), observation=None
) -> tuple[DataFrame, DataFrame]:
    """Bronze typing with row-level quarantine.

    Every standard column is cast to its type.  A row whose non-NULL raw value
    does not cast goes to the rejected frame (with the reason) instead of
    failing the load; NULL stays NULL, as a SQL cast would leave it.  The same
    holds for amounts that a later exact sum could not hold: NaN, infinities and
    values from ``MONEY_LIMIT`` on.  A record the CSV reader could not split into
    its fields (``_corrupt_record``) is rejected as ``malformed``; a reason that
    the source gave already (``_reject_reason``) goes before.  Columns that
    already have their type (a typed source such as parsed API items) are
    checked for range only.
    """
    current = dict(df.dtypes)
    to_cast = {n: k for n, k in types.items() if current.get(n) != k}
    # Typed once, in columns of their own that the checks and the good rows read.
    value = {n: f"_typed_{n}" if n in to_cast else n for n in types}
    typed = df.select("*", *[_typed(n, k).alias(value[n]) for n, k in to_cast.items()])
    checks = {}
    if CORRUPT in df.columns:
        checks["malformed"] = F.col(CORRUPT).isNull()
    checks |= {f"bad_{n}": F.col(n).isNull() | F.col(value[n]).isNotNull() for n, k in to_cast.items() if k != "string"}
    checks |= {f"range_{n}": F.col(n).isNull() | (F.abs(F.col(value[n])) < F.lit(MONEY_LIMIT)) for n, k in types.items() if k == "double"}
    if not checks:
        checks = {"never": F.lit(True)}  # keeps the observation wiring uniform
    first = F.col(REASON) if REASON in df.columns else None  # rejected by the source already
    good, bad = split_valid(typed, checks, observation=observation, first=first)
    good = good.select(*[F.col(value[n]).alias(n) for n in types], *keep)
    return good, bad.drop(*[value[n] for n in to_cast])


def rounded(c: str, decimals: int = 2) -> Column:
    """Decimal or double measure -> double rounded half away from zero."""
    return round_half_away(c, decimals)
