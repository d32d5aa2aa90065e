"""Number parsing for messy raw text, as native expressions (no UDFs).

Raw files arrive as strings; every parser returns NULL (not an exception)
for text it cannot read, so callers can quarantine such rows instead of
failing the whole file.  ``try_cast`` keeps ANSI mode on everywhere else.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.columns import as_col


# What counts as a number in raw text.  The cast alone would also read "100d", "12f", "NaN" and "Infinity".
NUMBER = r"^ *([+-]?(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?) *$"
# The same with a decimal part or an exponent: numbers that an integer cast doesn't read.
FRACTIONAL = r"^ *([+-]?(?:[0-9]+[.][0-9]*|[.][0-9]+|[0-9]+(?=[eE]))(?:[eE][+-]?[0-9]+)?) *$"


def plain_double(c: Column, pattern: str = NUMBER) -> Column:
    """Text to DOUBLE if it is a plain, finite number (blanks around it aside), else NULL.

    The pattern's match is what is cast, so the text stands in the value once (and the value twice in
    the result): nested expressions don't multiply, inside CASE branches either.
    """
    value = F.regexp_extract(c, pattern, 1).try_cast("double")  # no match is empty text, which casts to NULL
    return F.when(F.abs(value) < F.lit(float("inf")), value)


# Every dot of a text that has a comma anywhere, with what stands before it: the first match needs a comma ahead,
# each further one starts where the last ended.
DOTS_BEFORE_COMMA = r"(?:^(?=[^,]*,)|\G(?!^))([^.]*)[.]"


def parse_brl(c, unparseable: float | None = 0.0) -> Column:
    """Brazilian money, tax-report variant.

    Strip ``R$`` and blanks.  With both ``,`` and ``.`` present the dots are
    thousands separators and the comma is the decimal mark; with only ``,`` it
    is the decimal mark; otherwise the text is read as is.  Text that still
    does not parse gives ``unparseable`` (0.0 by default, NULL to quarantine).
    """
    s = F.replace(F.trim(as_col(c).cast("string")), F.lit("R$"), F.lit(""))
    no_dots = F.regexp_replace(s, DOTS_BEFORE_COMMA, "$1")
    value = plain_double(F.replace(no_dots, F.lit(","), F.lit(".")))
    if unparseable is None:
        return value
    return F.coalesce(value, F.lit(float(unparseable)))


def parse_amount(c) -> Column:
    """Money, spending-API variant: string text always drops dots, then comma -> dot.

    ``"1234.56"`` therefore reads as 123456.0.  Unreadable text gives NULL
    (the source raised; we quarantine).  Numeric columns pass through.
    """
    col = as_col(c)
    s = col.cast("string")
    text = F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain_double(text)


def parse_area(c) -> Column:
    """Decimal comma to dot; anything else unreadable gives NULL."""
    return plain_double(F.replace(F.trim(as_col(c).cast("string")), F.lit(","), F.lit(".")))


def parse_count(c, missing: int | None = 0) -> Column:
    """``int(float(text without ',' and '.'))``: thousands marks of either kind dropped.

    ``"1234.0"`` reads as 12340, as in the source.  Missing text gives
    ``missing``; unreadable text gives NULL.
    """
    s = F.trim(as_col(c).cast("string"))
    if missing is not None:
        s = F.regexp_replace(F.coalesce(s, F.lit("")), r"^\z", str(missing))
    return plain_double(F.regexp_replace(s, r"[,.]", "")).try_cast("bigint")


def parse_year(c) -> Column:
    """``int(float(text without ','))``; unreadable gives NULL."""
    s = F.replace(F.trim(as_col(c).cast("string")), F.lit(","), F.lit(""))
    return plain_double(s).try_cast("int")


def format_brl(c, decimals: int = 2, prefix: str = "R$ ") -> Column:
    """Render a number as Brazilian money text, e.g. ``R$ 1.234,56``."""
    us = F.format_number(as_col(c).cast("double"), decimals)  # 1,234.56
    return F.concat(F.lit(prefix), F.translate(us, ",.", ".,"))
