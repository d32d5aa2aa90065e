"""Whole domain runs, rejects and change detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.plans import deforestation, medallion, spending, tax
from strata.plans import tpch_analogues as A
from strata.plans.common import CORRUPT, type_columns
from strata.plans.queries.gold import FLAG_ROWS_SQL, TAX_GOLD_SQL, rollup_sql, spending_gold_sql
from strata.plans.queries.registry import register
from strata.plans.queries.sql import dbl, def_rows_sql
from strata.session import scratch_path
from strata.sources.csv import publish_csv, read_csv, write_csv
from strata.sources.json_items import split_payloads
from strata.sources.tables import read_table
from strata.streaming.incremental import changed_files, file_state

WIDE_SILVER = {"years": (1900, 2100)}
WIDE_AREAS = {"years": (1900, 2100), "area_open_range": (0.0, 1e15)}


def _as_text(df, columns):
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


@register(
    "q_csv_quoted",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'malformed' WHEN o_custkey % 50 = 7 THEN 'bad_price' ELSE 'good' END AS outcome,
       CASE WHEN o_orderstatus <> 'P' THEN 'says "' || o_orderpriority || '", twice' || chr(10) || 'over two lines' END AS note,
       CASE WHEN o_orderstatus <> 'P' AND o_custkey % 50 <> 7 THEN o_totalprice END AS price
FROM orders""",
)
def q_csv_quoted(spark, sf_dir):
    """Raw records with delimiters, doubled quotes and line breaks in a field; some have a field too few or
    too many, some a price that is no number.  Good rows and rejects, each with its reason.
    """
    o = A.table(spark, sf_dir, "orders")
    note = F.concat(F.lit('"says ""'), "o_orderpriority", F.lit('"", twice\nover two lines"'))
    price = F.when(F.col("o_custkey") % 50 == 7, F.lit("12d")).otherwise(F.col("o_totalprice").cast("string"))
    whole = F.concat_ws(",", F.col("o_orderkey").cast("string"), note, price)
    ragged = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(",", F.col("o_orderkey").cast("string"), note)).otherwise(F.concat(whole, F.lit(",more")))
    path = scratch_path(spark, "csv-quoted")
    o.select(F.when(F.col("o_orderstatus") == "P", ragged).otherwise(whole).alias("value")).write.text(path)
    raw = read_csv(spark, path, schema="o_orderkey string, note string, price string", header=False, corrupt_column=CORRUPT)
    good, bad = type_columns(raw, {"o_orderkey": "bigint", "note": "string", "price": "double"})
    rejects = bad.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("_reject_reason").alias("outcome"),
        F.when(F.col("_reject_reason") != "malformed", F.col("note")).alias("note"), F.lit(None).cast("double").alias("price"),
    )
    return good.select("o_orderkey", F.lit("good").alias("outcome"), "note", "price").unionByName(rejects)


@register(
    "q_json_rejects",
    """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'unreadable' WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 'no_year'
            WHEN l_linenumber = 3 THEN 'no_items' ELSE 'good' END AS outcome,
       CASE WHEN NOT (l_returnflag = 'A' AND l_linenumber = 1) AND NOT (l_returnflag = 'R' AND l_linenumber = 2) AND l_linenumber <> 3
            THEN l_quantity END AS amount
FROM lineitem""",
)
def q_json_rejects(spark, sf_dir):
    """API payloads, some cut off, some with text for a year or without items: the items, and the payloads kept with a reason."""
    li = A.table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    year = F.year("l_shipdate").cast("string")
    good = F.concat(F.lit('{"year":'), year, F.lit(',"items":[{"coluna":"x","valor":'), F.col("l_quantity").cast("string"), F.lit("}]}"))
    payload = (
        F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.expr("substring('{\"year\":1999,\"items\":[{\"colu', 1)"))
        .when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 2), F.concat(F.lit('{"year":"unknown","items":[{"valor":'), year, F.lit("}]}")))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit('{"year":'), year, F.lit("}")))
        .otherwise(good)
    )
    docs = li.select(*key, payload.alias("payload"))
    items, bad = split_payloads(docs, "payload", keep=key, fields={"year": "int"})
    return (
        items.select(*key, F.lit("good").alias("outcome"), "amount")
        .unionByName(bad.select(*key, F.col("_reject_reason").alias("outcome"), F.lit(None).cast("double").alias("amount")))
        .withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    )


def _gold_biome(spark, root):
    gold = read_table(spark, medallion.Layout(root).gold("deforestation_by_biome"), schema=medallion.GOLD_SCHEMAS["deforestation_by_biome"])
    return gold.select(F.col("year").cast("bigint").alias("year"), "biome", "area_km2", "cumulative_km2", "prev_year_km2", "yoy_change_pct")


@register("q_incremental_years", rollup_sql(False))
def q_incremental_years(spark, sf_dir):
    """Every year spread over two files that arrive as two batches: each batch rebuilds its years from all files."""
    root = scratch_path(spark, "incremental-years")
    rows = _as_text(A.rollup_rows(spark, sf_dir), deforestation.RAW_COLUMNS)
    for i in (0, 1):
        write_csv(rows.where(F.pmod(F.crc32("biome"), F.lit(2)) == i).coalesce(1), f"{root}/landing/d{i}", columns=deforestation.RAW_COLUMNS)
    medallion.run_incremental(spark, "deforestation", f"{root}/landing/*", f"{root}/lake", max_files_per_batch=1, audit=False,
                              silver_kwargs=WIDE_AREAS)
    return _gold_biome(spark, f"{root}/lake")


@register(
    "q_quarantine_table",
    f"""
WITH d AS (SELECT year, biome, state, sum(area) AS area FROM ({def_rows_sql('l.l_quantity')}) GROUP BY ALL)
SELECT CASE WHEN year % 2 = 0 THEN 'even' ELSE 'odd' END AS run_id, CASE WHEN biome = 'ASIA' THEN 'bad_year' ELSE 'bad_area_km2' END AS reason,
       count(*) AS n_rows
FROM d WHERE biome IN ('ASIA', 'EUROPE') GROUP BY ALL""",
)
def q_quarantine_table(spark, sf_dir):
    """Two runs with rows that cannot be typed: the quarantine table holds the rejects of both."""
    root = scratch_path(spark, "quarantine")
    detail = A.deforestation_rows(spark, sf_dir, F.col("l_quantity")).groupBy("year", "biome", "state").agg(F.sum("area_km2").alias("area_km2"))
    raw = detail.select(
        F.when(F.col("biome") == "ASIA", F.lit("20xx")).otherwise(F.col("year").cast("string")).alias("year"), "biome", "state",
        F.when(F.col("biome") == "EUROPE", F.lit("NaN")).otherwise(F.col("area_km2").cast("string")).alias("area_km2"), F.col("year").alias("_y"),
    )
    for run, part in (("even", 0), ("odd", 1)):
        medallion.run_deforestation(spark, raw.where(F.col("_y") % 2 == part).drop("_y"), root, audit=False, silver_kwargs=WIDE_AREAS, run_id=run)
    rejected = read_table(spark, medallion.Layout(root).rejected("deforestation"))
    return rejected.groupBy("run_id", F.col("_reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "q_republished_file",
    """
SELECT CASE l_linestatus_file WHEN 'F' THEN 'kept' WHEN 'O' THEN 'changed' ELSE 'added' END AS change, n_rows
FROM (SELECT o_orderstatus AS l_linestatus_file, count(*) AS n_rows FROM orders GROUP BY 1)""",
)
def q_republished_file(spark, sf_dir):
    """Files rewritten under their names with other content are found by their hash; those rewritten alike are not."""
    root = scratch_path(spark, "republished")
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    o = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")

    def publish(status, df):
        publish_csv(df.where(F.col("o_orderstatus") == status), f"{root}/landing", status, "o_orderkey", parts)

    for status in ("F", "O"):
        publish(status, o)
    file_state(spark, f"{root}/landing").write.parquet(f"{root}/state")
    publish("F", o)
    publish("O", o.withColumn("o_totalprice", F.col("o_totalprice") + 1))
    publish("P", o)
    changes = changed_files(file_state(spark, f"{root}/landing"), spark.read.parquet(f"{root}/state"))
    named = changes.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "change")
    rows = read_csv(spark, f"{root}/landing").groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    joined = rows.join(named, "file", "left")
    return joined.groupBy(F.coalesce("change", F.lit("kept")).alias("change")).agg(F.sum("n").alias("n_rows"))


@register("q_medallion_tax", TAX_GOLD_SQL)
def q_medallion_tax(spark, sf_dir):
    """The whole tax run over raw text: bronze, silver, gold by bracket, gate, view."""
    root = scratch_path(spark, "medallion-tax")
    write_csv(_as_text(A.tax_rows(spark, sf_dir), tax.RAW_COLUMNS), f"{root}/raw", columns=tax.RAW_COLUMNS)
    medallion.run_tax(spark, f"{root}/raw", f"{root}/lake", audit=False, silver_kwargs=WIDE_SILVER)
    gold = read_table(spark, medallion.Layout(f"{root}/lake").gold("tax_by_bracket"), schema=medallion.GOLD_SCHEMAS["tax_by_bracket"])
    return gold.drop("_computed_at").withColumn("year", F.col("year").cast("bigint"))


# Fixed values of this analogue: return flag -> a category code that looks like a number.
CODES = {"A": "02", "N": "10", "R": "12"}
CODE_ROWS_SQL = f"SELECT * REPLACE (CASE functional_category WHEN 'A' THEN '02' WHEN 'N' THEN '10' ELSE '12' END AS functional_category) FROM ({FLAG_ROWS_SQL})"


def _spending_by_code(spark, sf_dir):
    code = F.coalesce(*[F.when(F.col("functional_category") == k, F.lit(v)) for k, v in CODES.items()])
    rows = A.spending_rows_by_flag(spark, sf_dir).withColumn("functional_category", code).withColumn("description", F.lit("line"))
    return _as_text(rows, spending.RAW_COLUMNS)


@register("q_medallion_spending", spending_gold_sql(CODE_ROWS_SQL))
def q_medallion_spending(spark, sf_dir):
    """The whole spending run over raw rows whose category codes look like numbers ('02' stays '02')."""
    root = scratch_path(spark, "medallion-spending")
    medallion.run_spending(spark, _spending_by_code(spark, sf_dir), root, audit=False, silver_kwargs=WIDE_SILVER)
    gold = read_table(spark, medallion.Layout(root).gold("spending_by_function"), schema=medallion.GOLD_SCHEMAS["spending_by_function"])
    return gold.drop("_computed_at").withColumn("year", F.col("year").cast("bigint"))


@register(
    "q_cross_domain",
    f"""
WITH area AS (SELECT year, sum(CAST(area_km2 AS DECIMAL(38,2))) AS v FROM ({rollup_sql(False)}) GROUP BY year),
spent AS (SELECT year, sum(CAST(executed_brl AS DECIMAL(38,2))) AS v FROM ({spending_gold_sql(CODE_ROWS_SQL)}) WHERE functional_category = '02' GROUP BY year),
years AS (SELECT year FROM area UNION SELECT year FROM spent)
SELECT y.year, round({dbl('coalesce(a.v, 0)')}, 2) AS deforested_km2, round({dbl('coalesce(s.v, 0)')}, 2) AS env_spending_brl,
       CASE WHEN a.v > 0 THEN round({dbl('s.v')} / {dbl('a.v')}, 0) END AS spending_per_km2_deforested
FROM years y LEFT JOIN area a ON a.year = y.year LEFT JOIN spent s ON s.year = y.year""",
)
def q_cross_domain(spark, sf_dir):
    """All three domain runs into one lake, then the cross-domain tables, read through their view."""
    root = scratch_path(spark, "cross-domain")
    medallion.run_deforestation(spark, _as_text(A.rollup_rows(spark, sf_dir), deforestation.RAW_COLUMNS), root, audit=False, silver_kwargs=WIDE_AREAS)
    medallion.run_spending(spark, _spending_by_code(spark, sf_dir), root, audit=False, silver_kwargs=WIDE_SILVER)
    medallion.run_tax(spark, _as_text(A.tax_rows(spark, sf_dir), tax.RAW_COLUMNS), root, audit=False, silver_kwargs=WIDE_SILVER)
    medallion.run_cross_domain(spark, root, category="02", audit=False)
    view = spark.table("gold_deforestation_vs_spending")
    return view.select(F.col("year").cast("bigint").alias("year"), "deforested_km2", "env_spending_brl", "spending_per_km2_deforested")
