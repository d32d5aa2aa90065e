"""The domain jobs run over the driver's TPC-H-like tables.

The reference's inputs (tax, deforestation, spending) are re-shaped from the
driver tables so the *same* library functions run over whole tables whose
size grows with the scale factor:

* deforestation-shaped rows: (year, biome <- r_name, state <- n_name, area_km2 <- a measure)
* spending-shaped rows: (year, functional_category, description, budgeted_brl, executed_brl)
* tax-shaped rows: (year, income_bracket <- o_orderpriority, state, num_declarations,
  taxable_income_brl, tax_due_brl)

Where a fact table feeds a join on a key it aggregates onto (lineitem ->
supplier or part or order) it is aggregated first: the partial aggregate runs
map-side before the shuffle, so a hot key is collapsed before it is exchanged
and the join sees one row per (key, year) instead of every line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import year_of
from strata.functions.numeric import money, round_half_away


# --- Fixed values: schemas of the driver tables (identical at every scale factor) ---
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}
# ---------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table read with its declared schema (no footer inference on every read)."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def net_price() -> F.Column:
    """Line revenue ``price * (1 - discount)`` rounded to cents (row level, like a silver amount)."""
    return round_half_away("l_extendedprice * (1.0D - l_discount)", 2)


def supplier_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, n_name, r_name).

    Nation and region are joined first.  No hint: the planner broadcasts them
    only while its size estimate (from the file sizes) is under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-checks with the
    measured size; beyond that the joins shuffle.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    return s.join(geo, s.s_nationkey == geo.n_nationkey).select("s_suppkey", "n_name", "r_name")


def lines_by_supplier_year(spark: SparkSession, sf_dir: str, value: F.Column) -> DataFrame:
    """Pre-aggregated lineitem: (l_suppkey, year, v) with ``v`` an exact decimal sum."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", year_of("l_shipdate").alias("year"), value.alias("v"))
    return li.groupBy("l_suppkey", "year").agg(F.sum(money("v")).alias("v"))


def deforestation_rows(spark: SparkSession, sf_dir: str, value: F.Column) -> DataFrame:
    """Deforestation-shaped detail rows at (supplier, year) grain."""
    agg = lines_by_supplier_year(spark, sf_dir, value)
    geo = supplier_geo(spark, sf_dir)
    return agg.join(geo, agg.l_suppkey == geo.s_suppkey).select(
        "year",
        F.col("r_name").alias("biome"),
        F.col("n_name").alias("state"),
        F.col("v").cast("double").alias("area_km2"),
    )


def rollup_rows(spark: SparkSession, sf_dir: str, rollup_until: int = 1998, detail_from: int = 1997) -> DataFrame:
    """'ALL' rows per (year, region) up to ``rollup_until`` plus state rows from ``detail_from``.

    Years in between carry both kinds, which is where the rollup policy matters.
    Both kinds come out of one pass: each input row is exploded into the
    marker(s) it contributes to and then aggregated once.
    """
    rows = deforestation_rows(spark, sf_dir, F.col("l_quantity"))
    y = F.col("year")
    targets = F.filter(
        F.array(F.when(y <= rollup_until, F.lit("ALL")), F.when(y >= detail_from, F.col("state"))),
        lambda x: x.isNotNull(),
    )
    tagged = rows.select("year", "biome", F.explode(targets).alias("state"), "area_km2")
    return tagged.groupBy("year", "biome", "state").agg(F.sum(money("area_km2")).cast("double").alias("area_km2"))


def spending_rows_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending-shaped rows: category = return flag, budgeted = list price, executed = net price."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        year_of("l_shipdate").cast("int").alias("year"),
        F.col("l_returnflag").alias("functional_category"),
        F.col("l_returnflag").alias("description"),
        F.col("l_extendedprice").alias("budgeted_brl"),
        net_price().alias("executed_brl"),
    )


def spending_rows_by_part_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spending-shaped rows per part type, lineitem pre-aggregated on (l_partkey, year)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", year_of("l_shipdate").alias("year"), F.col("l_extendedprice").alias("b"), net_price().alias("e")
    )
    agg = li.groupBy("l_partkey", "year").agg(F.sum(money("b")).alias("b"), F.sum(money("e")).alias("e"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return agg.join(part, agg.l_partkey == part.p_partkey).select(
        F.col("year").cast("int").alias("year"),
        F.col("p_type").alias("functional_category"),
        F.col("p_type").alias("description"),
        F.col("b").cast("double").alias("budgeted_brl"),
        F.col("e").cast("double").alias("executed_brl"),
    )


# The line statuses of the generator, and the state each stands for.
LINE_STATES = {"O": "ALL", "F": "F"}
REST = "REST"


def tax_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax-shaped rows at (order, line status) grain.

    Open lines are the national ('ALL') rows; closed lines carry their status; lines of any other
    status, or of none, are one further row (``REST``).  Lineitem is aggregated per order alone, each
    status in sums of its own, so one exchange on the order key serves the aggregate and the join.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linestatus", F.col("l_extendedprice").alias("base"), round_half_away("l_extendedprice * l_tax", 2).alias("tax")
    )
    sums = []
    states = LINE_STATES | {REST: REST}
    for status in states:
        mine = F.col("l_linestatus") == status if status != REST else ~F.coalesce(F.col("l_linestatus").isin(*LINE_STATES), F.lit(False))
        sums += [F.count_if(mine).alias(f"n_{status}"), F.sum(F.when(mine, money("base"))).alias(f"base_{status}"),
                 F.sum(F.when(mine, money("tax"))).alias(f"tax_{status}")]
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    wide = li.groupBy("l_orderkey").agg(*sums)
    rows = F.array(*(
        F.struct(F.lit(state).alias("state"), F.col(f"n_{status}").alias("n"), F.col(f"base_{status}").alias("base"), F.col(f"tax_{status}").alias("tax"))
        for status, state in states.items()
    ))
    joined = wide.join(orders, wide.l_orderkey == orders.o_orderkey)
    return joined.select("o_orderdate", "o_orderpriority", F.inline(rows)).where("n > 0").select(
        year_of("o_orderdate").cast("int").alias("year"),
        F.col("o_orderpriority").alias("income_bracket"),
        "state",
        F.col("n").cast("bigint").alias("num_declarations"),
        F.col("base").cast("double").alias("taxable_income_brl"),
        F.col("tax").cast("double").alias("tax_due_brl"),
    )


def orders_by_customer_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_custkey, year, n, p): orders collapsed per customer and year before any join on the customer.

    The partial aggregate runs map-side, so a customer with very many orders reaches the join as
    one row per year.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", year_of("o_orderdate").alias("year"), "o_totalprice")
    return o.groupBy("o_custkey", "year").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("p"))


def orders_by_segment_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, c_mktsegment, total_price decimal) from orders joined to customer."""
    o = orders_by_customer_year(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.groupBy("year", "c_mktsegment").agg(F.sum("p").alias("total_price"))
