"""Numeric column expressions: rounding, guarded ratios, exact money sums.

All helpers return ``Column`` objects built from built-in functions, so they
stay JVM-side and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.columns import as_col

# Above 2**52 every double is already an integer: rounding it is the identity.
_INTEGRAL_LIMIT = float(2**52)

# Money in the source data carries two decimals; sums run on this type so
# they are exact and do not depend on partitioning or row order.
MONEY = "decimal(18,2)"
MONEY_LIMIT = 1e16  # absolute amounts from here on don't fit MONEY


def _double_sql(x: str) -> str:
    return f"CAST(({x}) AS DOUBLE)"


def round_half_away_sql(x: str, decimals: int = 0) -> str:
    """SQL text of ``round_half_away`` over the SQL expression ``x``."""
    scale = f"{float(10 ** decimals)!r}D"
    v = _double_sql(x)
    y = f"({v} * {scale})"
    a = f"abs({y})"
    whole = f"CAST(floor({a}) AS DOUBLE)"
    rounded = f"({whole} + CASE WHEN {a} - {whole} >= 0.5D THEN 1.0D ELSE 0.0D END)"
    signed = f"CASE WHEN {y} < 0.0D THEN -{rounded} ELSE {rounded} END"
    # The result is NaN or infinite exactly when y is; the engine then returns x.
    return (
        f"CASE WHEN isnan({y}) OR {a} = CAST('Infinity' AS DOUBLE) THEN {v} "
        f"WHEN {a} >= {_INTEGRAL_LIMIT!r}D THEN {y} / {scale} ELSE ({signed}) / {scale} END"
    )


def round_half_away(c, decimals: int = 0) -> Column:
    """Round a double half away from zero on its binary value.

    This is ``round(x * 10^n) / 10^n`` with C ``round`` semantics, the rule the
    SQL engines used for the reference apply to DOUBLE, step by step: for
    ``|x * 10^n| >= 2^52`` the product is already whole and the result is
    ``(x * 10^n) / 10^n`` as the floating-point operations give it; a NaN or
    infinite result returns ``x``.  Spark's ``F.round`` rounds the *decimal
    text* of the double instead, so ``1.005`` becomes ``1.01`` there and
    ``1.0`` here.  NULL, NaN and infinities pass through.

    ``c`` may be a column name or SQL text (built as one expression, one call
    into the JVM) or a Column (built node by node).
    """
    if isinstance(c, str):
        return F.expr(round_half_away_sql(c, decimals))
    x = c.cast("double")
    scale = float(10**decimals)
    y = x * F.lit(scale)
    a = F.abs(y)
    whole = F.floor(a).cast("double")
    rounded = whole + F.when(a - whole >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0))
    signed = F.when(y < 0, -rounded).otherwise(rounded)
    return (
        F.when(F.isnan(y) | (a == F.lit(float("inf"))), x)
        .when(a >= F.lit(_INTEGRAL_LIMIT), y / F.lit(scale))
        .otherwise(signed / F.lit(scale))
    )


def _default_sql(default: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if default is None else f"{float(default)!r}D"


def pct(numerator, denominator, decimals: int = 2, default: float | None = 0.0) -> Column:
    """``CASE WHEN d > 0 THEN round(n / d * 100, k) ELSE default END``.

    A NULL or non-positive denominator gives ``default`` (0.0 or NULL), so the
    division never raises under ANSI mode.  Names/SQL text build one expression.
    """
    if isinstance(numerator, str) and isinstance(denominator, str):
        n, d = _double_sql(numerator), _double_sql(denominator)
        value = round_half_away_sql(f"{n} / {d} * 100.0D", decimals)
        return F.expr(f"CASE WHEN {d} > 0.0D THEN {value} ELSE {_default_sql(default)} END")
    n = as_col(numerator).cast("double")
    d = as_col(denominator).cast("double")
    value = round_half_away(n / d * F.lit(100.0), decimals)
    return F.when(d > 0, value).otherwise(F.lit(default).cast("double"))


def ratio(numerator, denominator, decimals: int = 0, default: float | None = None) -> Column:
    """``CASE WHEN d > 0 THEN round(n / d, k) ELSE default END``."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        n, d = _double_sql(numerator), _double_sql(denominator)
        value = round_half_away_sql(f"{n} / {d}", decimals)
        return F.expr(f"CASE WHEN {d} > 0.0D THEN {value} ELSE {_default_sql(default)} END")
    n = as_col(numerator).cast("double")
    d = as_col(denominator).cast("double")
    value = round_half_away(n / d, decimals)
    return F.when(d > 0, value).otherwise(F.lit(default).cast("double"))


def change_pct(current, previous, decimals: int = 1) -> Column:
    """Year-over-year change ``(cur - prev) / prev * 100`` when ``prev > 0``, else NULL."""
    if isinstance(current, str) and isinstance(previous, str):
        cur, prev = _double_sql(current), _double_sql(previous)
        value = round_half_away_sql(f"({cur} - {prev}) / {prev} * 100.0D", decimals)
        return F.expr(f"CASE WHEN {prev} > 0.0D THEN {value} ELSE CAST(NULL AS DOUBLE) END")
    cur = as_col(current).cast("double")
    prev = as_col(previous).cast("double")
    value = round_half_away((cur - prev) / prev * F.lit(100.0), decimals)
    return F.when(prev > 0, value).otherwise(F.lit(None).cast("double"))


def money(c, kind: str = MONEY) -> Column:
    """An amount as an exact decimal; decimals beyond the scale of ``kind`` are rounded off."""
    return as_col(c).cast(kind)
