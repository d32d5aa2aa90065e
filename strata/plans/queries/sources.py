"""Sources and sinks: CSV, Parquet tables, landing folders, number parsing, quarantine,
JSON payloads, array series and allocation (S1 - S14, P20 - P27, C5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.columns import year_of
from strata.functions.numeric import money, round_half_away
from strata.functions.parse import format_brl, parse_amount, parse_area, parse_brl, parse_count
from strata.operators.cleaning import tag_valid
from strata.plans import deforestation, spending, tax
from strata.plans import tpch_analogues as A
from strata.plans.common import type_columns
from strata.session import scratch_path
from strata.sources.csv import read_csv, string_schema, write_csv
from strata.sources.landing import read_landing
from strata.sources.harmonise import harmonise_deforestation, harmonise_tax
from strata.sources.json_items import explode_items, read_json_lines_items
from strata.sources.series import explode_series
from strata.sources.tables import read_table, write_table
from strata.plans.queries.registry import register
from strata.plans.queries.sql import NET_SQL
from strata.plans.queries.gold import by_state_sql, spending_gold_sql

# ----------------------------------------------------------------------------
# Sources and sinks
# ----------------------------------------------------------------------------

ORDERS_RAW = ["o_orderkey", "o_custkey", "year", "o_totalprice", "o_orderpriority"]
ORDERS_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "year": "int",
    "o_totalprice": "double",
    "o_orderpriority": "string",
}


@register(
    "q_csv_ingest",
    """
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS year, o_totalprice, o_orderpriority
FROM orders""",
)
def q_csv_ingest(spark, sf_dir):
    """Orders written as a header CSV in a fixed field order, read back with a text schema, typed with
    row-level quarantine and per-file lineage.
    """
    o = A.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", year_of("o_orderdate").alias("year"), "o_totalprice", "o_orderpriority"
    )
    path = scratch_path(spark, "csv-ingest")
    write_csv(o, path, columns=ORDERS_RAW)
    raw = read_csv(spark, path, schema=string_schema(ORDERS_RAW), with_source=True)
    good, _bad = type_columns(raw, ORDERS_TYPES, keep=("_source_file",))
    return good.select(
        "o_orderkey", "o_custkey", F.col("year").cast("bigint").alias("year"), "o_totalprice", "o_orderpriority"
    )


def _orders_by_year(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders")
    return o.select(
        year_of("o_orderdate").cast("int").alias("year"), "o_orderkey", "o_orderstatus", "o_totalprice"
    )


def count_by_year(df):
    return df.groupBy(F.col("year").cast("bigint").alias("year")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).cast("double").alias("total_price")
    )


@register(
    "q_partitioned_roundtrip",
    """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders GROUP BY 1""",
)
def q_partitioned_roundtrip(spark, sf_dir):
    """Orders written as a year-partitioned table (no shuffle), read back by partition discovery."""
    path = scratch_path(spark, "orders-by-year")
    write_table(_orders_by_year(spark, sf_dir), path, partition_by=["year"], sort_by=["o_orderkey"])
    return count_by_year(read_table(spark, path))


BACKFILL_YEAR = 1998


@register(
    "q_backfill_year",
    f"""
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders
WHERE year(o_orderdate) <> {BACKFILL_YEAR} OR o_orderstatus = 'F'
GROUP BY 1""",
)
def q_backfill_year(spark, sf_dir):
    """Write all years, then rewrite one year (closed orders only) with dynamic overwrite."""
    path = scratch_path(spark, "orders-backfill")
    all_years = _orders_by_year(spark, sf_dir)
    write_table(all_years, path, partition_by=["year"], overwrite="all")
    one_year = all_years.where((F.col("year") == BACKFILL_YEAR) & (F.col("o_orderstatus") == "F"))
    write_table(one_year, path, partition_by=["year"], overwrite="partitions")
    return count_by_year(read_table(spark, path))


def _tax_drop_a(o):
    """';' file, Portuguese headers, Brazilian money, thousands marks, blank state on urgent orders."""
    return o.where(F.col("o_orderstatus") == "F").select(
        F.col("year").cast("string").alias("ano"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("Faixa de Renda"),
        F.format_number(F.col("o_custkey").cast("double"), 0).alias("quantidade"),
        format_brl(F.col("o_totalprice")).alias("rendimento_tributavel"),
        format_brl(F.col("o_custkey") / 100, prefix="").alias("imposto_devido"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")).alias("uf"),
    )


def _tax_drop_b(o):
    """',' file, English headers, no money columns, blank bracket on low-priority orders."""
    return o.where(F.col("o_orderstatus") != "F").select(
        F.col("year").cast("string").alias("year"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("bracket"),
        F.col("o_custkey").cast("string").alias("count"),
        F.col("o_orderstatus").alias("UF"),
    )


@register(
    "q_header_harmonise",
    """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS income_bracket,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus ELSE 'ALL' END AS state,
       o_custkey AS num_declarations, o_totalprice AS taxable_income_brl,
       CAST(o_custkey AS DOUBLE) / 100 AS tax_due_brl
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT CAST(year(o_orderdate) AS BIGINT), o_orderpriority, o_orderstatus, o_custkey,
       CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
FROM orders WHERE o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW'""",
)
def q_header_harmonise(spark, sf_dir):
    """Two raw tax drops with different delimiters and headers: first bytes of each file, one scan of all,
    alias harmonisation, Brazilian money and count parsing.
    """
    o = A.table(spark, sf_dir, "orders").select(
        year_of("o_orderdate").alias("year"), "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"
    )
    root = scratch_path(spark, "tax-landing")
    write_csv(_tax_drop_a(o), f"{root}/a", sep=";")
    write_csv(_tax_drop_b(o), f"{root}/b", sep=",")
    good, _bad = read_landing(spark, f"{root}/*", harmonise_tax)
    return good.select(
        F.col("year").cast("bigint").alias("year"),
        "income_bracket", "state", "num_declarations", "taxable_income_brl", "tax_due_brl",
    )


def _digits_as(p_sql: str, int_digits_from_end: int) -> str:
    d = f"CAST(CAST(round({p_sql} * 100) AS BIGINT) AS VARCHAR)"
    return (
        f"CAST(substr({d}, 1, length({d}) - {int_digits_from_end}) || '.' || "
        f"substr({d}, length({d}) - {int_digits_from_end} + 1) AS DOUBLE)"
    )


@register(
    "q_money_parse",
    f"""
SELECT o_orderkey,
       o_totalprice AS tax_money, o_totalprice AS spend_money, o_totalprice AS area_value,
       o_custkey AS count_value,
       CASE WHEN o_totalprice < 1000 THEN o_totalprice
            WHEN o_totalprice < 1000000 THEN {_digits_as('o_totalprice', 5)}
            ELSE CAST(0 AS DOUBLE) END AS us_text_as_brl
FROM orders""",
)
def q_money_parse(spark, sf_dir):
    """The number parsers over formatted order amounts, including the US-text-as-BRL trap."""
    o = A.table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.select(
        "o_orderkey",
        parse_brl(format_brl(price)).alias("tax_money"),
        parse_amount(format_brl(price, prefix="")).alias("spend_money"),
        parse_area(F.replace(F.format_string("%.2f", price), F.lit("."), F.lit(","))).alias("area_value"),
        parse_count(F.format_number(F.col("o_custkey").cast("double"), 0)).alias("count_value"),
        parse_brl(F.format_number(price, 2)).alias("us_text_as_brl"),
    )


@register(
    "q_quarantine",
    """
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'bad_amount'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'bad_year'
            ELSE 'good' END AS outcome,
       count(*) AS n_rows,
       CAST(sum(CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)
           AS total_amount
FROM orders GROUP BY 1""",
)
def q_quarantine(spark, sf_dir):
    """Raw text rows with injected defects, split into good rows and rejected rows by reason."""
    o = A.table(spark, sf_dir, "orders")
    raw = o.select(
        F.when(
            (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"), F.lit("n/a")
        ).otherwise(year_of("o_orderdate").cast("string")).alias("year_text"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("R$ --")).otherwise(format_brl(F.col("o_totalprice"))).alias(
            "amount_text"
        ),
    )
    typed = raw.select(
        F.col("year_text").try_cast("int").alias("year"), parse_brl("amount_text", unparseable=None).alias("amount")
    )
    tagged = tag_valid(typed, {"bad_amount": F.col("amount").isNotNull(), "bad_year": F.col("year").isNotNull()})
    # Good and rejected counts in one aggregate over one scan.
    return tagged.groupBy(F.coalesce(F.col("_reject_reason"), F.lit("good")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(money("amount")).cast("double").alias("total_amount")
    )


_PAYLOAD_COLUMNS = ["l_returnflag", "l_linenumber", "l_extendedprice", "l_linestatus", "l_quantity"]


def _item_payload() -> F.Column:
    """One API-style payload per line: a text amount, a numeric amount and an empty item."""
    br = format_brl(F.col("l_extendedprice"), prefix="")
    return F.concat(
        F.lit('{"items":[{"coluna":"'), F.col("l_returnflag"),
        F.lit('","rotulo":"line '), F.col("l_linenumber").cast("string"),
        F.lit('","valor":"'), br,
        F.lit('"},{"coluna":"'), F.col("l_linestatus"),
        F.lit('","valor":'), F.col("l_quantity").cast("string"),
        F.lit('},{"rotulo":"tax"}]}'),
    )


@register(
    "q_json_items",
    """
SELECT l_orderkey, l_returnflag AS category, 'line ' || CAST(l_linenumber AS VARCHAR) AS description,
       l_extendedprice AS amount FROM lineitem
UNION ALL
SELECT l_orderkey, l_linestatus, '', l_quantity FROM lineitem
UNION ALL
SELECT l_orderkey, '', 'tax', CAST(0 AS DOUBLE) FROM lineitem""",
)
def q_json_items(spark, sf_dir):
    """API-style payloads (a text amount, a numeric amount, an empty item) exploded into items."""
    li = A.table(spark, sf_dir, "lineitem").select("l_orderkey", *_PAYLOAD_COLUMNS)
    return explode_items(li.select("l_orderkey", _item_payload().alias("payload")), "payload", keep=["l_orderkey"])


# Fixed values of this analogue: return flag -> category text as a raw API reports it.
API_CATEGORY_BY_FLAG = {"A": "Saúde", "N": "Educacao", "R": "Previdencia Social"}


def _api_payload() -> F.Column:
    """One JSON line per line item: the year and one item (category text, label, BR money text)."""
    category = F.coalesce(*[F.when(F.col("l_returnflag") == k, F.lit(v)) for k, v in API_CATEGORY_BY_FLAG.items()])
    return F.concat(
        F.lit('{"year":'), year_of("l_shipdate").cast("string"),
        F.lit(',"items":[{"coluna":"'), category,
        F.lit('","rotulo":"line '), F.col("l_linenumber").cast("string"),
        F.lit('","valor":"'), format_brl(A.net_price(), prefix=""),
        F.lit('"}]}'),
    )


# Oracle rows of the API path, stated for the texts above: 'Saúde' is Health, 'Educacao' Education, 'Previdencia
# Social' Social Security; the net price is both amounts.
API_ROWS_SQL = f"""
    SELECT CAST(year(l_shipdate) AS BIGINT) AS year,
           CASE l_returnflag WHEN 'A' THEN 'Health' WHEN 'N' THEN 'Education' ELSE 'Social Security' END AS functional_category,
           CAST({NET_SQL} AS DECIMAL(18,2)) AS budgeted, CAST({NET_SQL} AS DECIMAL(18,2)) AS executed
    FROM lineitem"""


@register("q_api_spending", spending_gold_sql(API_ROWS_SQL))
def q_api_spending(spark, sf_dir):
    """API payloads (JSON lines) -> items -> spending bronze/silver -> gold by function."""
    root = scratch_path(spark, "api-landing")
    li = A.table(spark, sf_dir, "lineitem").select("l_shipdate", "l_returnflag", "l_linenumber", "l_extendedprice", "l_discount")
    li.select(_api_payload().alias("value")).write.mode("overwrite").text(root)
    items = read_json_lines_items(spark, root, fields={"year": "int"})
    raw, _rejected = spending.api_items_to_raw(items)
    bronze, _bad = spending.bronze(raw, audit=False)  # typed items pass through
    silver = spending.silver(bronze, years=(1900, 2100), audit=False)
    return spending.gold_by_function(silver, audit=False).withColumn("year", F.col("year").cast("bigint"))


def _deforestation_drops(spark, sf_dir, root):
    """Two raw layouts: ';' with Portuguese headers and decimal commas, and ',' without a biome column."""
    rows = A.deforestation_rows(spark, sf_dir, F.col("l_quantity"))
    a = rows.where(F.col("biome") != "ASIA").select(
        F.col("year").cast("string").alias("ano"),
        F.replace(F.col("area_km2").cast("string"), F.lit("."), F.lit(",")).alias("area"),
        F.lower("state").alias("uf"),
        F.col("biome").alias("bioma"),
    )
    b = rows.where(F.col("biome") == "ASIA").select(
        F.col("year").cast("string").alias("Year"),
        F.col("area_km2").cast("string").alias("Area"),
        F.col("state").alias("UF"),
    )
    write_csv(a, f"{root}/a", sep=";")
    write_csv(b, f"{root}/b", sep=",")


@register(
    "q_deforestation_landing",
    by_state_sql("l.l_quantity", "CASE WHEN g.r_name = 'ASIA' THEN 'Amazonia' ELSE g.r_name END"),
)
def q_deforestation_landing(spark, sf_dir):
    """Raw drops of two layouts -> harmonised -> silver (rules, ranges) -> gold by state."""
    root = scratch_path(spark, "prodes-landing")
    _deforestation_drops(spark, sf_dir, root)
    good, _bad = read_landing(spark, f"{root}/*", harmonise_deforestation)
    silver = deforestation.silver(good, years=(1900, 2100), area_open_range=(0.0, 1e15), audit=False)
    return deforestation.gold_by_state(silver, audit=False).withColumn("year", F.col("year").cast("bigint"))


@register(
    "q_posexplode_series",
    """
WITH annual AS (
    SELECT c.c_mktsegment, CAST(year(o.o_orderdate) AS BIGINT) AS year,
           CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2
)
SELECT c_mktsegment, year, total AS budgeted, round(total * 0.95, 2) AS executed FROM annual""",
)
def q_posexplode_series(spark, sf_dir):
    """Yearly totals packed into one dense array per segment, then exploded back."""
    annual = A.orders_by_segment_year(spark, sf_dir).withColumn("total", F.col("total_price").cast("double"))
    packed = annual.groupBy("c_mktsegment").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.map_from_entries(F.collect_list(F.struct("year", "total"))).alias("by_year"),
    )
    series = packed.select(
        "c_mktsegment",
        "first_year",
        F.transform(
            F.sequence("first_year", "last_year"), lambda y: F.coalesce(F.try_element_at(F.col("by_year"), y), F.lit(0.0))
        ).alias("values"),
    )
    rows = explode_series(series, ["c_mktsegment"], "values", "first_year", value="budgeted")
    return rows.select(
        "c_mktsegment",
        "year",
        "budgeted",
        round_half_away("budgeted * 0.95D", 2).alias("executed"),
    )


@register(
    "q_allocate",
    f"""
WITH oc AS (
    SELECT CAST(year(o.o_orderdate) AS BIGINT) AS year, c.c_mktsegment, o.o_totalprice
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
), yearly AS (
    SELECT year, count(*) AS total_declarations,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_tax
    FROM oc GROUP BY year
), seg AS (
    SELECT year, c_mktsegment AS income_bracket, count(*) AS n,
           CAST(length(c_mktsegment) * 100 AS BIGINT) AS rate_bp
    FROM oc GROUP BY 1, 2
), w AS (
    SELECT seg.*, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY year) AS DOUBLE) AS decl_share,
           CAST(rate_bp AS DOUBLE) / CAST(10000 AS DOUBLE) AS rate, CAST(n * rate_bp AS DOUBLE) AS weight,
           CAST(sum(n * rate_bp) OVER (PARTITION BY year) AS DOUBLE) AS wsum
    FROM seg
), a AS (
    SELECT w.*, y.total_declarations, y.total_tax, y.total_tax * w.weight / w.wsum AS tax
    FROM w JOIN yearly y ON w.year = y.year
)
SELECT year, income_bracket, 'ALL' AS state,
       CAST(trunc(total_declarations * decl_share) AS BIGINT) AS num_declarations,
       round(CASE WHEN rate > 0 THEN tax / rate ELSE 0 END, 2) AS taxable_income_brl,
       round(tax, 2) AS tax_due_brl
FROM a""",
)
def q_allocate(spark, sf_dir):
    """Yearly order totals split over segments by weight = orders x rate (an equi-join on year)."""
    o = A.orders_by_customer_year(spark, sf_dir)
    c = A.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    oc = o.join(c, o.o_custkey == c.c_custkey)
    # One row per (year, segment); the branches below read it from one exchange.
    seg = oc.groupBy("year", F.col("c_mktsegment").alias("income_bracket")).agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    yearly = seg.groupBy("year").agg(
        F.sum("n").alias("total_declarations"), F.sum("p").cast("double").alias("total_tax")
    )
    seg = seg.withColumn("rate_bp", (F.length("income_bracket") * 100).cast("bigint"))
    year_n = seg.groupBy("year").agg(F.sum("n").alias("_yn"))
    brackets = seg.join(year_n, "year").select(
        "year",
        "income_bracket",
        (F.col("n").cast("double") / F.col("_yn").cast("double")).alias("decl_share"),
        (F.col("rate_bp") / F.lit(10000.0)).alias("rate"),
        (F.col("n") * F.col("rate_bp")).cast("double").alias("weight"),
    )
    out = tax.allocate_compiled(yearly, brackets)
    return out.withColumn("year", F.col("year").cast("bigint"))
