"""Header harmonisation: map varying raw headers onto the standard raw schema.

A standard column takes the first alias that is present in the file *and*
non-empty on the row, else a literal default (``row.get(a) or row.get(b) or
default``).  Parsing happens with native expressions; a value that cannot be
parsed becomes NULL and the row goes to quarantine instead of failing the
whole file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import strip_ws
from strata.functions.parse import parse_area, parse_brl, parse_count, parse_year

# --- Fixed values: header aliases of the raw sources, in priority order -----
TAX_ALIASES: dict[str, tuple[list[str], str | None]] = {
    "year": (["ano", "Ano", "year"], None),
    "income_bracket": (["faixa", "Faixa de Renda", "bracket"], None),
    "num_declarations": (["quantidade", "Quantidade de Declarações", "count"], None),
    "taxable_income_brl": (["rendimento_tributavel", "Rendimento Tributável"], "0"),
    "tax_due_brl": (["imposto_devido", "Imposto Devido"], "0"),
    "state": (["uf", "UF"], "ALL"),
}

DEFORESTATION_ALIASES: dict[str, tuple[list[str], str | None]] = {
    "year": (["year", "ano", "Year"], None),
    "area_km2": (["area", "area_km2", "Area"], None),
    "state": (["state", "uf", "UF"], "ALL"),
    "biome": (["biome", "bioma"], "Amazon"),
}
# ---------------------------------------------------------------------------


FIELDS = "_fields"  # a reader's map from raw header names to texts, where it gives no columns


def _has(df: DataFrame, name: str) -> bool:
    return FIELDS in df.columns or name in df.columns


def _raw(df: DataFrame, name: str) -> Column:
    return F.col(FIELDS)[name] if FIELDS in df.columns else F.col(f"`{name}`")


def first_alias(df: DataFrame, aliases: Sequence[str], default: str | None = None) -> Column:
    """First present, non-empty alias column, else ``default`` (NULL when None)."""
    cols = [F.nullif(_raw(df, a).cast("string"), F.lit("")) for a in aliases if _has(df, a)]
    if default is not None:
        cols.append(F.lit(default))
    if not cols:
        return F.lit(None).cast("string")
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


LINEAGE = ("_source_file",)
CORRUPT = "_corrupt_record"  # where a reader leaves the text of a record with a wrong number of fields
REASON = "_reject_reason"


def _lineage(df: DataFrame) -> list[str]:
    return [c for c in LINEAGE if c in df.columns]


def raw_names(spec: Mapping[str, tuple[Sequence[str], str | None]]) -> list[str]:
    """Every header name that a spec looks for."""
    return list(dict.fromkeys(a for aliases, _ in spec.values() for a in aliases))


def harmonise(df: DataFrame, spec: Mapping[str, tuple[Sequence[str], str | None]]) -> DataFrame:
    """Select one string column per standard name from its aliases (lineage columns kept)."""
    cols = [first_alias(df, aliases, default).alias(name) for name, (aliases, default) in spec.items()]
    return df.select(*cols, *_lineage(df))


def _tagged(raw: DataFrame, spec: Mapping, required: Sequence[str], types: Mapping[str, Column], checked: Sequence[str]) -> DataFrame:
    """Typed standard columns, lineage, why a row is rejected, and the raw record of a rejected row.

    Rows without a ``required`` value are dropped, as in the source; records with a wrong number of
    fields are not rows, and are rejected as ``malformed``.
    """
    torn = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    names = [c for c in raw_names(spec) if _has(raw, c)]
    text = F.to_json(F.struct(*[_raw(raw, c).alias(c) for c in names])) if names else F.lit(None).cast("string")
    record = F.coalesce(F.col(CORRUPT), text) if CORRUPT in raw.columns else text
    cols = [first_alias(raw, aliases, default).alias(name) for name, (aliases, default) in spec.items()]
    rows = raw.select(*cols, *_lineage(raw), torn.alias("_torn"), record.alias("_record"))
    there = F.col("_torn")
    present = F.lit(True)
    for name in required:
        present = present & F.col(name).isNotNull()
    typed = rows.where(there | present).select(*[c.alias(n) for n, c in types.items()], *_lineage(raw), "_torn", "_record")
    reason = F.when(F.col("_torn"), F.lit("malformed"))
    for name in checked:
        reason = reason.when(F.col(name).isNull(), F.lit(f"bad_{SHORT.get(name, name)}"))
    typed = typed.withColumn(REASON, reason)
    return typed.withColumn("_raw_record", F.when(F.col(REASON).isNotNull(), F.col("_record"))).drop("_torn", "_record")


SHORT = {"num_declarations": "count", "area_km2": "area"}  # names of rejections


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(standard rows, rejected rows) of a tagged frame."""
    return tagged.where(F.col(REASON).isNull()).drop(REASON, "_raw_record"), tagged.where(F.col(REASON).isNotNull())


def tag_tax(raw: DataFrame) -> DataFrame:
    """Messy tax records as typed standard rows with ``_reject_reason``.

    Rows need a year and a bracket (others are dropped, as in the source).
    Counts drop ``,`` and ``.``; money uses the tax variant (unparseable -> 0.0).
    """
    types = {
        "year": parse_year("year"),
        "income_bracket": strip_ws("income_bracket"),
        "state": strip_ws("state"),
        "num_declarations": parse_count("num_declarations"),
        "taxable_income_brl": parse_brl("taxable_income_brl"),
        "tax_due_brl": parse_brl("tax_due_brl"),
    }
    return _tagged(raw, TAX_ALIASES, ["year", "income_bracket"], types, ["year", "num_declarations"])


def tag_deforestation(raw: DataFrame) -> DataFrame:
    """Messy deforestation records as typed standard rows with ``_reject_reason``.

    Rows need a year and an area; the area uses a decimal comma.
    """
    types = {
        "year": F.col("year").try_cast("double").try_cast("int"),
        "biome": F.col("biome"),
        "state": F.col("state"),
        "area_km2": parse_area("area_km2"),
    }
    return _tagged(raw, DEFORESTATION_ALIASES, ["year", "area_km2"], types, ["year", "area_km2"])


def harmonise_tax(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messy tax records -> (standard rows, rejected rows); see ``tag_tax``."""
    return split_tagged(tag_tax(raw))


def harmonise_deforestation(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messy deforestation records -> (standard rows, rejected rows); see ``tag_deforestation``."""
    return split_tagged(tag_deforestation(raw))


harmonise_tax.columns = tag_tax.columns = raw_names(TAX_ALIASES)
harmonise_deforestation.columns = tag_deforestation.columns = raw_names(DEFORESTATION_ALIASES)
