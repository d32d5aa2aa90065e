"""Mixed drops in a run, ranged CSV, landing index, versioned tables, view catalogue, ordered output,
and keys too large for one task (S1, S3, S7 - S9, S13, J11, J12, I1, O1, O2, W1, W2, W4)."""

from __future__ import annotations

import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from strata.functions.columns import year_of
from strata.functions.numeric import money
from strata.operators import annual_sum, parse_named_checks, spread, with_share
from strata.plans import deforestation, medallion, spending
from strata.plans import tpch_analogues as A
from strata.plans.common import type_columns
from strata.plans.queries.gold import BY_STATE_SQL, by_state_sql, rollup_sql
from strata.plans.queries.registry import register
from strata.plans.queries.sources import ORDERS_RAW, ORDERS_TYPES
from strata.plans.queries.runs import WIDE_AREAS, WIDE_SILVER, _as_text
from strata.plans.queries.sql import dbl, def_rows_sql
from strata.session import scratch_path
from strata.sources.csv import write_csv
from strata.sources.json_items import read_payload_lines
from strata.sources.ranges import read_columns
from strata.sources.tables import read_ordered, read_table, with_audit, write_ordered, write_table
from strata.sources.versions import attach_views, read_version, versions, write_version

# ----------------------------------------------------------------------------
# Raw drops
# ----------------------------------------------------------------------------


def _mixed_drops(spark, sf_dir, root):
    """Raw deforestation drops of three layouts, and records that cannot be used.

    ``a``: ';', Portuguese headers, decimal commas.  ``b``: ',', English headers in another order, no
    biome column.  ``c``: ';' with a quoted note over two lines in every record.  ``d``: years that are
    no numbers (2-HIGH orders), records with a field too few or too many (1-URGENT orders).
    """
    rows = A.deforestation_rows(spark, sf_dir, F.col("l_quantity"))
    year, area = F.col("year").cast("string"), F.col("area_km2").cast("string")
    note = F.concat(F.lit('said "'), "state", F.lit('"; then\nmore'))
    a = rows.where(~F.col("biome").isin("ASIA", "EUROPE")).select(
        year.alias("ano"), F.replace(area, F.lit("."), F.lit(",")).alias("area"), F.lower("state").alias("uf"), F.col("biome").alias("bioma"))
    b = rows.where(F.col("biome") == "ASIA").select(F.col("state").alias("UF"), area.alias("Area"), year.alias("Year"))
    c = rows.where(F.col("biome") == "EUROPE").select(note.alias("nota"), year.alias("year"), area.alias("area_km2"), "state", "biome")
    for name, df, sep in (("a", a, ";"), ("b", b, ","), ("c", c, ";")):
        write_csv(df, f"{root}/{name}", sep=sep)
    o = A.table(spark, sf_dir, "orders")
    torn = F.when(F.col("o_orderkey") % 2 == 0, F.lit("2020;1.5;PA")).otherwise(F.lit("2020;1.5;PA;Amazon;more"))
    lines = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        F.when(F.col("o_orderpriority") == "2-HIGH", F.lit("20xx;1.5;PA;Amazon")).otherwise(torn).alias("value"))
    header = spark.createDataFrame([("year;area;state;biome",)], "value string")
    header.coalesce(1).unionByName(lines.coalesce(1)).coalesce(1).write.text(f"{root}/d")


@register("q_mixed_run", by_state_sql("l.l_quantity", "CASE WHEN g.r_name = 'ASIA' THEN 'Amazonia' ELSE g.r_name END"))
def q_mixed_run(spark, sf_dir):
    """A whole domain run over a landing folder of mixed layouts: one scan, bronze, silver, gold by state."""
    root = scratch_path(spark, "mixed-run")
    _mixed_drops(spark, sf_dir, f"{root}/landing")
    medallion.run_deforestation(spark, f"{root}/landing/*", f"{root}/lake", mixed=True, audit=False, silver_kwargs=WIDE_AREAS)
    gold = read_table(spark, medallion.Layout(f"{root}/lake").gold("deforestation_by_state"))
    return gold.select(F.col("year").cast("bigint").alias("year"), "biome", "state", "area_km2", "prev_year_km2", "yoy_change_pct",
                       F.col("rank_in_year").cast("bigint").alias("rank_in_year"))


@register(
    "q_mixed_rejects",
    """
SELECT CASE WHEN o_orderpriority = '2-HIGH' THEN 'bad_year' ELSE 'malformed' END AS reason,
       CASE WHEN o_orderpriority = '2-HIGH' THEN '{"year":"20xx","area":"1.5","state":"PA","biome":"Amazon"}'
            WHEN o_orderkey % 2 = 0 THEN '2020;1.5;PA' ELSE '2020;1.5;PA;Amazon;more' END AS record,
       count(*) AS n_rows
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2""",
)
def q_mixed_rejects(spark, sf_dir):
    """What a run over mixed drops rejects: in its quarantine partition, with the reason and the raw record."""
    root = scratch_path(spark, "mixed-rejects")
    _mixed_drops(spark, sf_dir, f"{root}/landing")
    medallion.run_deforestation(spark, f"{root}/landing/*", f"{root}/lake", mixed=True, audit=False, silver_kwargs=WIDE_AREAS, run_id="mixed")
    rejected = read_table(spark, medallion.Layout(f"{root}/lake").rejected("deforestation")).where("run_id = 'mixed'")
    return rejected.groupBy(F.col("_reject_reason").alias("reason"), F.col("_raw_record").alias("record")).agg(F.count(F.lit(1)).alias("n_rows"))


def _joined_lines(batches):
    """The rows of a batch as one text of several lines."""
    for batch in batches:
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(["\n".join(batch.column(0).to_pylist())])], ["value"])


@register(
    "q_csv_ranges",
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'malformed' ELSE 'good' END AS outcome,
       CASE WHEN o_orderstatus <> 'P' THEN 'says "' || o_orderpriority || '", twice' || chr(10) || 'over "two" lines' END AS note,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
FROM orders""",
)
def q_csv_ranges(spark, sf_dir):
    """One CSV file with quotes and line breaks inside fields, read by many tasks in ranges of 64 KB."""
    o = A.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv-ranges")
    note = F.concat(F.lit('says "'), "o_orderpriority", F.lit('", twice\nover "two" lines'))
    quoted = F.concat(F.lit('"'), F.replace(note, F.lit('"'), F.lit('""')), F.lit('"'))
    whole = F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted, F.col("o_totalprice").cast("string"))
    record = F.when(F.col("o_orderstatus") == "P", F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted)).otherwise(whole)
    header = spark.createDataFrame([("o_orderkey,note,price",)], "value string").coalesce(1)
    # Records are made, and joined to long texts, by all tasks: the one that writes the file copies those.
    blocks = o.select(record.alias("value")).mapInArrow(_joined_lines, "value string")
    header.unionByName(blocks.repartition(1)).coalesce(1).write.text(path)
    raw = read_columns(spark, path, ["o_orderkey", "note", "price"], range_bytes=1 << 16)
    good, bad = type_columns(raw, {"o_orderkey": "bigint", "note": "string", "price": "double"})
    rejects = bad.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("_reject_reason").alias("outcome"),
                         F.lit(None).cast("string").alias("note"), F.lit(None).cast("double").alias("price"))
    return good.select("o_orderkey", F.lit("good").alias("outcome"), "note", "price").unionByName(rejects)


@register(
    "q_lineage_audit",
    """
SELECT o_orderkey, 'drop-' || o_orderstatus AS drop_name, '2024-01-02 03:04:05' AS ingested_at FROM orders""",
)
def q_lineage_audit(spark, sf_dir):
    """Bronze rows with the file they came from and an audit time (given, so that reruns agree)."""
    root = scratch_path(spark, "lineage")
    o = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", year_of("o_orderdate").alias("year"), "o_totalprice", "o_orderpriority", "o_orderstatus")
    for status in ("F", "O", "P"):
        write_csv(o.where(F.col("o_orderstatus") == status), f"{root}/drop-{status}", columns=ORDERS_RAW)
    good, _ = type_columns(read_columns(spark, f"{root}/*", ORDERS_RAW), ORDERS_TYPES, keep=("_source_file",))
    audited = with_audit(good, "ingested_at", datetime.datetime(2024, 1, 2, 3, 4, 5, tzinfo=datetime.UTC))
    return audited.select("o_orderkey", F.regexp_extract("_source_file", "/([^/]+)/[^/]+$", 1).alias("drop_name"), F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at"))


@register(
    "q_landing_index",
    f"""
WITH d AS (SELECT year, biome, state FROM ({def_rows_sql('l.l_quantity')}) GROUP BY ALL)
SELECT 'd' || (length(biome) % 3) AS drop_name, year, count(*) AS n_rows FROM d GROUP BY ALL""",
)
def q_landing_index(spark, sf_dir):
    """Three drops, a batch each: the landing index knows which file holds how many rows of which year."""
    root = scratch_path(spark, "landing-index")
    rows = A.deforestation_rows(spark, sf_dir, F.col("l_quantity")).groupBy("year", "biome", "state").agg(F.sum("area_km2").alias("area_km2"))
    text = _as_text(rows, deforestation.RAW_COLUMNS)
    for i in range(3):
        write_csv(text.where(F.length("biome") % 3 == i).coalesce(1), f"{root}/landing/d{i}", columns=deforestation.RAW_COLUMNS)
    medallion.run_incremental(spark, "deforestation", f"{root}/landing/*", f"{root}/lake", max_files_per_batch=1, audit=False, silver_kwargs=WIDE_AREAS)
    index = medallion.landing_index(spark, f"{root}/lake", "deforestation")
    return index.where("year IS NOT NULL").groupBy(F.regexp_extract("file_path", "/([^/]+)/[^/]+$", 1).alias("drop_name"), F.col("year").cast("bigint").alias("year")).agg(
        F.sum("rows").alias("n_rows"))


@register(
    "q_api_rejects",
    """
SELECT CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'unreadable' WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 'no_year'
            WHEN l_linenumber = 3 THEN 'bad_amount' ELSE 'good' END AS outcome, count(*) AS n_rows
FROM lineitem GROUP BY 1""",
)
def q_api_rejects(spark, sf_dir):
    """A spending run over API payloads, some cut off, some without a year, some with an amount that is no
    number: bronze rows, and what is in quarantine.
    """
    root = scratch_path(spark, "api-rejects")
    li = A.table(spark, sf_dir, "lineitem")
    year = F.year("l_shipdate").cast("string")
    amount = F.when(F.col("l_linenumber") == 3, F.lit('"x,y"')).otherwise(F.col("l_quantity").cast("string"))
    no_year = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 2)
    payload = F.concat(F.lit('{"year":'), F.when(no_year, F.lit('"unknown"')).otherwise(year), F.lit(',"items":[{"coluna":"Saude","rotulo":"x","valor":'), amount, F.lit("}]}"))
    cut = F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1), F.substring(payload, 1, 30)).otherwise(payload)
    li.select(cut.alias("value")).write.text(f"{root}/landing")
    raw = spending.api_raw(read_payload_lines(spark, f"{root}/landing"))
    medallion.run_spending(spark, raw, f"{root}/lake", audit=False, silver_kwargs=WIDE_SILVER, run_id="api")
    L = medallion.Layout(f"{root}/lake")
    count = F.count(F.lit(1)).alias("n_rows")
    good = read_table(spark, L.bronze("spending")).groupBy(F.lit("good").alias("outcome")).agg(count)
    return good.unionByName(read_table(spark, L.rejected("spending")).groupBy(F.col("_reject_reason").alias("outcome")).agg(count))


NAMED_CHECKS = """
-- rows of each layer
-- name: bronze_row_count
SELECT count(*) FROM {bronze};
-- name: silver_row_count
SELECT count(*) FROM {silver};
-- name: silver_null_years
-- expect: eq 0
SELECT count(*) FROM {silver} WHERE year IS NULL;
-- name: silver_negative_areas
-- expect: eq 0
SELECT count(*) FROM {silver}
WHERE area_km2 < 0;
-- name: gold_biomes
-- expect: gte 2
SELECT count(DISTINCT biome) FROM {deforestation_by_biome};
"""


@register(
    "q_named_checks",
    f"""
WITH d AS (SELECT year, biome, state, sum(area) AS area FROM ({def_rows_sql('l.l_quantity')}) GROUP BY ALL)
SELECT 'bronze_row_count' AS check_name, count(*) AS value, 'gt' AS op, true AS passed FROM d
UNION ALL SELECT 'silver_row_count', count(*), 'gt', true FROM d
UNION ALL SELECT 'silver_null_years', 0, 'eq', true
UNION ALL SELECT 'silver_negative_areas', 0, 'eq', true
UNION ALL SELECT 'gold_biomes', count(DISTINCT biome), 'gte', true FROM d""",
)
def q_named_checks(spark, sf_dir):
    """A run with a text of named checks over its layers and gold tables: what each found."""
    root = scratch_path(spark, "named-checks")
    rows = A.deforestation_rows(spark, sf_dir, F.col("l_quantity")).groupBy("year", "biome", "state").agg(F.sum("area_km2").alias("area_km2"))
    out = medallion.run_deforestation(spark, _as_text(rows, deforestation.RAW_COLUMNS), root, audit=False, silver_kwargs=WIDE_AREAS, checks=parse_named_checks(NAMED_CHECKS))
    names = [c["name"] for c in parse_named_checks(NAMED_CHECKS)]
    found = [(d["check_name"], int(d["value"]), d["op"], d["passed"]) for d in out["details"] if d["check_name"] in names and "table_name" not in d]
    return spark.createDataFrame(found, "check_name string, value long, op string, passed boolean")


# ----------------------------------------------------------------------------
# Tables and views
# ----------------------------------------------------------------------------


@register(
    "q_table_versions",
    """
WITH o AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)
SELECT 1 AS version, year, count(*) AS n_rows, CAST(sum(price) AS DOUBLE) AS total FROM o GROUP BY year
UNION ALL
SELECT 2, year, count(*), CAST(sum(price + CASE WHEN year >= 1997 THEN 1 ELSE 0 END) AS DOUBLE) FROM o GROUP BY year""",
)
def q_table_versions(spark, sf_dir):
    """A versioned table by year, then some of its years replaced: both versions stay readable."""
    path = scratch_path(spark, "versions")
    o = A.table(spark, sf_dir, "orders").select("o_orderkey", year_of("o_orderdate").alias("year"), "o_totalprice")
    write_version(o, path, ["year"])
    later = o.where("year >= 1997").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_version(later, path, ["year"], overwrite="partitions")
    out = None
    for version in versions(spark, path):
        totals = read_version(spark, path, version).groupBy("year").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(money("o_totalprice")).cast("double").alias("total"))
        totals = totals.select(F.lit(version).alias("version"), "year", "n_rows", "total")
        out = totals if out is None else out.unionByName(totals)
    return out


@register("q_view_catalogue", rollup_sql(False))
def q_view_catalogue(spark, sf_dir):
    """A run publishes its views; another session attaches them by name and selects."""
    root = scratch_path(spark, "catalogue")
    medallion.run_deforestation(spark, _as_text(A.rollup_rows(spark, sf_dir), deforestation.RAW_COLUMNS), root, audit=False, silver_kwargs=WIDE_AREAS, atomic=True)
    other = spark.newSession()
    attach_views(other, root)
    return other.table("gold_deforestation_by_biome").select(
        F.col("year").cast("bigint").alias("year"), "biome", "area_km2", "cumulative_km2", "prev_year_km2", "yoy_change_pct")


@register(
    "q_ordered_gold",
    f"""
SELECT row_number() OVER (ORDER BY year DESC, rank_in_year, biome, state) - 1 AS place, year, biome, state, area_km2, rank_in_year FROM ({BY_STATE_SQL})""",
)
def q_ordered_gold(spark, sf_dir):
    """Gold by state written in order over many files, and handed back with each row's place in it."""
    path = scratch_path(spark, "ordered")
    rows = A.deforestation_rows(spark, sf_dir, A.net_price())
    gold = deforestation.gold_by_state(rows, audit=False).withColumn("year", F.col("year").cast("bigint"))
    write_ordered(gold, path, [F.desc("year"), "rank_in_year", "biome", "state"], files=16)
    return read_ordered(spark, path, "place").select("place", "year", "biome", "state", "area_km2", "rank_in_year")


# ----------------------------------------------------------------------------
# Keys that don't fit one task
# ----------------------------------------------------------------------------


@register(
    "q_spread_trend",
    """
SELECT o_orderkey, o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate) AS DOUBLE) AS total_to_date,
       CAST(lag(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS DOUBLE) AS price_before
FROM orders""",
)
def q_spread_trend(spark, sf_dir):
    """Running total by date (peers included) and the order before, per status: three keys over all tasks."""
    o = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", money("o_totalprice").alias("price"))
    totals = spread.running_total(o, ["o_orderstatus"], "o_orderdate", "price", "total_to_date")
    both = spread.running_total(totals, ["o_orderstatus"], "o_orderkey", "price", "_sum", previous="price_before")
    return both.select("o_orderkey", "o_orderstatus", F.col("total_to_date").cast("double").alias("total_to_date"), F.col("price_before").cast("double").alias("price_before"))


@register(
    "q_spread_rank",
    """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC NULLS LAST) AS place FROM lineitem""",
)
def q_spread_rank(spark, sf_dir):
    """rank() of every line by quantity within its return flag: three keys, fifty values, ties across all tasks."""
    li = A.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_returnflag", "l_quantity")
    return spread.rank(li, ["l_returnflag"], "l_quantity", "place").drop("l_quantity")


@register(
    "q_spread_topn",
    """
SELECT * FROM (SELECT l_returnflag, l_orderkey, l_extendedprice, rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC NULLS LAST) AS place FROM lineitem)
WHERE place <= 100""",
)
def q_spread_topn(spark, sf_dir):
    """The hundred dearest lines of each return flag, ties included, without a flag in one task."""
    li = A.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey", "l_extendedprice")
    return spread.top_n(li, ["l_returnflag"], "l_extendedprice", 100, "place")


@register(
    "q_spread_share",
    f"""
WITH a AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v FROM lineitem GROUP BY ALL)
SELECT year, l_suppkey, CAST(v AS DOUBLE) AS revenue,
       CASE WHEN t > 0 THEN round({dbl('v')} / {dbl('t')} * 100, 2) ELSE {dbl('0')} END AS pct_of_total
FROM (SELECT a.*, (SELECT sum(o.v) FROM a o WHERE o.year = a.year) AS t FROM a)""",
)
def q_spread_share(spark, sf_dir):
    """Each supplier's share of its year: totals by a second aggregate over the written first one."""
    li = A.table(spark, sf_dir, "lineitem").select(year_of("l_shipdate").alias("year"), "l_suppkey", "l_extendedprice")
    annual = annual_sum(li, ["year", "l_suppkey"], {"revenue": "l_extendedprice"})
    shared = with_share(annual, ["year"], "revenue", "pct_of_total", method="table")
    return shared.select("year", "l_suppkey", F.col("revenue").cast("double").alias("revenue"), "pct_of_total")


@register("q_incremental_gold", rollup_sql(False))
def q_incremental_gold(spark, sf_dir):
    """Gold by biome in three updates: the years up to 1996 with a wrong 1995, 1995 again, then the years from 1997."""
    root = scratch_path(spark, "incremental-gold")
    rows = A.rollup_rows(spark, sf_dir).withColumn("year", F.col("year").cast("int"))
    write_table(rows, f"{root}/silver", ["year"])
    silver = read_table(spark, f"{root}/silver")
    early = silver.where("year <= 1996").withColumn("area_km2", F.when(F.col("year") == 1995, F.col("area_km2") * 2).otherwise(F.col("area_km2")))
    every = [r.year for r in silver.select("year").distinct().collect()]
    deforestation.update_gold_by_biome(early, f"{root}/state", [y for y in every if y <= 1996])
    deforestation.update_gold_by_biome(silver, f"{root}/state", [1995])
    gold = deforestation.update_gold_by_biome(silver, f"{root}/state", [y for y in every if y > 1996])
    return gold.withColumn("year", F.col("year").cast("bigint"))
