"""JSON API payloads ``{"items": [{"coluna", "rotulo", "valor"}, ...]}`` -> rows.

``valor`` is read as VARIANT so a JSON number and a JSON string can be told
apart: numbers pass through, strings use the spending-API money rule (drop
dots, comma to dot), anything else (null, missing) is 0.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.parse import parse_amount
from strata.session import scratch_path

ITEMS_SCHEMA = "items array<struct<coluna:string, rotulo:string, valor:variant>>"


def variant_amount(v: Column) -> Column:
    """Amount from a VARIANT: JSON numbers as they are, JSON strings by the money rule, else 0.0.

    The value is extracted once as text (cheaper than a typed extraction)
    and branched on the variant's type name.
    """
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    numeric = kind.startswith("DECIMAL") | kind.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")
    return (
        F.when(v.isNull(), F.lit(0.0))
        .when(kind == F.lit("STRING"), parse_amount(text))
        .when(numeric, text.try_cast("double"))
        .when(kind == F.lit("BOOLEAN"), F.when(text == F.lit("true"), F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(F.lit(0.0))
    )


def explode_items(
    df: DataFrame, json_col: str, keep: list[str] | None = None, fields: dict[str, str] | None = None
) -> DataFrame:
    """One row per item (an empty item included) with defaults '' / '' / 0 for missing fields.

    ``amount`` is NULL only for string amounts that cannot be parsed (the
    source raised there), so callers can quarantine them.  ``fields`` maps
    top-level payload fields to SQL types (e.g. ``{"year": "int"}``); they are
    read in the same single parse and carried onto every item.  Payloads that
    cannot be read give no items here; ``rejected_payloads`` returns them.
    """
    doc = df.select(*(keep or []), _document(json_col, fields or {}).alias("_doc"))
    good = F.when(_reason(fields or {}).isNull(), F.col("_doc").getField("items"))
    return _items(doc, good, {k: F.col("_doc").getField(k) for k in fields or {}}, keep)


def _items(df: DataFrame, items: Column, fields: dict[str, Column], keep: list[str] | None) -> DataFrame:
    """One typed row per element of ``items``.

    The generator takes an expression, and gives the fields and the amounts too: conditions on a plain
    column under it, or on columns beside it, would be pushed below the parse and repeat it, and those on
    an amount made above it would repeat the amount's whole expression once per use.
    """
    given = lambda i: {"category": i.getField("coluna"), "description": i.getField("rotulo"), "amount": variant_amount(i.getField("valor"))} | fields
    items = F.transform(items, lambda i: F.struct(*[v.alias(k) for k, v in given(i).items()]))
    return df.select(*(keep or []), F.inline(items)).select(
        *(keep or []),
        *fields,
        F.coalesce(F.col("category"), F.lit("")).alias("category"),
        F.coalesce(F.col("description"), F.lit("")).alias("description"),
        "amount",
    )


def parse_payloads(df: DataFrame, json_col: str, keep: list[str] | None = None, fields: dict[str, str] | None = None) -> DataFrame:
    """Every payload with what it says: ``keep``, ``fields``, ``items`` and, of a rejected one, ``payload`` and ``_reject_reason``."""
    doc = df.select(*(keep or []), F.col(json_col).alias("payload"), _document(json_col, fields or {}).alias("_doc"))
    tagged = doc.withColumn("_reject_reason", _reason(fields or {}))
    return tagged.select(
        *(keep or []), *[F.col("_doc").getField(k).alias(k) for k in fields or {}],
        F.when(F.col("_reject_reason").isNull(), F.col("_doc").getField("items")).alias("items"),
        F.when(F.col("_reject_reason").isNotNull(), F.col("payload")).alias("payload"), "_reject_reason",
    )


def split_payloads(df: DataFrame, json_col: str, keep: list[str] | None = None, fields: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(items, rejected payloads) of payloads that are parsed once, into a table that both are read from."""
    spark = df.sparkSession
    path = scratch_path(spark, "payloads")
    parse_payloads(df, json_col, keep, fields).write.parquet(path)
    parsed = spark.read.parquet(path)
    bad = parsed.where("_reject_reason IS NOT NULL")
    return _items(parsed, F.col("items"), {k: F.col(k) for k in fields or {}}, keep), bad.select(*(keep or []), "payload", "_reject_reason")


def _document(json_col: str, fields: dict[str, str]) -> Column:
    schema = ", ".join([f"{k} {t}" for k, t in fields.items()] + [ITEMS_SCHEMA, "_unread string"])
    return F.from_json(F.col(json_col), schema, {"columnNameOfCorruptRecord": "_unread"})


def _reason(fields: dict[str, str]) -> Column:
    """Why a parsed payload (``_doc``) is rejected; NULL for a good one (its item list may be empty)."""
    doc = F.col("_doc")
    reason = F.when(doc.isNull() | (doc.getField("items").isNull() & doc.getField("_unread").isNotNull()), F.lit("unreadable"))
    for name in fields:
        reason = reason.when(doc.getField(name).isNull(), F.lit(f"no_{name}"))
    return reason.when(doc.getField("_unread").isNotNull(), F.lit("unreadable")).when(doc.getField("items").isNull(), F.lit("no_items"))


def rejected_payloads(df: DataFrame, json_col: str, keep: list[str] | None = None, fields: dict[str, str] | None = None) -> DataFrame:
    """The payloads ``explode_items`` cannot read: ``keep``, ``payload`` (the text as it came) and ``_reject_reason``.

    ``unreadable``: not a JSON document of the expected shape; ``no_<field>``: a requested field is
    missing or has another type; ``no_items``: no item list.  A NULL payload is unreadable.
    """
    parsed = parse_payloads(df, json_col, keep, fields)
    return parsed.where("_reject_reason IS NOT NULL").select(*(keep or []), "payload", "_reject_reason")


def read_json_items(spark: SparkSession, path: str) -> DataFrame:
    """Each file is one payload document (one API response).

    A document is parsed whole, so one file is one task: fine for API pages,
    not for very large files.  Those should arrive as JSON lines
    (``read_json_lines_items``), which split like any text file.
    """
    docs = spark.read.option("wholetext", True).text(path).withColumn("_source_file", F.col("_metadata.file_path"))
    return explode_items(docs, "value", keep=["_source_file"])


def read_json_lines_items(spark: SparkSession, path: str, fields: dict[str, str] | None = None) -> DataFrame:
    """One payload per line (JSON lines).  Splittable: large drops spread over all tasks.

    ``fields`` maps top-level payload fields to SQL types, e.g. ``{"year": "int"}``,
    parsed together with the items.
    """
    return explode_items(read_payload_lines(spark, path), "value", keep=["_source_file"], fields=fields)


def read_payload_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, _source_file``: one payload per line, as text."""
    return spark.read.text(path).withColumn("_source_file", F.col("_metadata.file_path"))
