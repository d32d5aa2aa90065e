"""Ordered, first-match-wins text normalisation.

A rule set is a list of ``(patterns, value)``; a row takes the value of the
first rule with any LIKE pattern matching ``lower(col)``, otherwise it keeps
its input.  The chain compiles to one ``CASE WHEN`` expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.columns import as_col

Rule = tuple[Sequence[str], str]

# --- Fixed values (must equal the reference's rules; order matters) ---------
# Biome names, matched on lower(biome).
BIOME_RULES: list[Rule] = [
    (["%amazon%", "%amazônia%"], "Amazonia"),
    (["%cerrado%"], "Cerrado"),
    (["%atlantic%", "%mata%atlântica%"], "Mata Atlantica"),
    (["%caatinga%"], "Caatinga"),
    (["%pampa%"], "Pampa"),
    (["%pantanal%"], "Pantanal"),
]

# Functional spending categories, matched on lower(functional_category).
# English "social security" falls through '%previd%' and lands on
# '%security%' -> 'Public Safety': the order is part of the behaviour.
CATEGORY_RULES: list[Rule] = [
    (["%saude%", "%saúde%"], "Health"),
    (["%educa%"], "Education"),
    (["%previd%"], "Social Security"),
    (["%defesa%", "%defense%"], "Defense"),
    (["%assist%social%"], "Social Assistance"),
    (["%meio%ambient%", "%environment%"], "Environment"),
    (["%ci%ncia%", "%tecnol%", "%science%"], "Science & Technology"),
    (["%seguran%", "%security%"], "Public Safety"),
]
# ---------------------------------------------------------------------------


def normalise_by_rules(c, rules: Sequence[Rule], lowercase: bool = True) -> Column:
    """Map a string column through ordered LIKE rules; unmatched values pass through.

    A column name builds the whole chain as one SQL expression (one call into
    the JVM); a Column builds it node by node.
    """
    if isinstance(c, str) and lowercase and rules:
        return F.expr(rules_sql("`" + c.replace("`", "``") + "`", rules))
    source = as_col(c)
    probe = F.lower(source) if lowercase else source
    expr = None
    for patterns, value in rules:
        cond = None
        for p in patterns:
            cond = probe.like(p) if cond is None else (cond | probe.like(p))
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return source if expr is None else expr.otherwise(source)


def normalise_state(c) -> Column:
    """State code: two-letter codes upper-cased, 'all' -> 'ALL', anything else upper-cased.

    All three branches of the source rule reduce to ``upper``.
    """
    return F.upper(as_col(c))


def rules_sql(column: str, rules: Sequence[Rule]) -> str:
    """The same rule chain as SQL text (used for oracle queries and docs)."""
    parts = []
    for patterns, value in rules:
        cond = " OR ".join(f"lower({column}) LIKE '{p}'" for p in patterns)
        escaped = value.replace("'", "''")
        parts.append(f"WHEN {cond} THEN '{escaped}'")
    return "CASE " + " ".join(parts) + f" ELSE {column} END"
