import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.functions import (
    BIOME_RULES,
    CATEGORY_RULES,
    normalise_by_rules,
    normalise_state,
    parse_amount,
    parse_area,
    parse_brl,
    parse_count,
    pct,
    ratio,
    round_half_away,
    rules_sql,
)


def test_round_half_away_matches_sql_engine_on_binary_ties(spark):
    rnd = random.Random(7)
    values = [1.005, 2.675, -1.005, 0.125, -0.125, 2.5, -2.5, 0.49999999999999994, 1e17, -3.3e16]
    values += [round(rnd.uniform(-1e6, 1e6), 3) for _ in range(3000)]
    values += [rnd.uniform(-1e4, 1e4) for _ in range(3000)]
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for n in (0, 1, 2):
        got = [r[0] for r in df.select(round_half_away("x", n)).collect()]
        con = duckdb.connect()
        want = [con.execute("SELECT round(?::DOUBLE, ?)", [v, n]).fetchone()[0] for v in values]
        mismatches = [(v, g, w) for v, g, w in zip(values, got, want) if g != w]
        assert not mismatches, mismatches[:5]


def test_round_half_away_passes_null_nan_inf(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double")
    out = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert out[0] is None and math.isnan(out[1]) and out[2] == float("inf")


def test_pct_and_ratio_guards(spark):
    df = spark.createDataFrame([(5.0, 20.0), (5.0, 0.0), (5.0, None), (5.0, -1.0), (1.0, 3.0)], "n double, d double")
    rows = df.select(
        pct("n", "d", 2, 0.0).alias("p0"), pct("n", "d", 1, None).alias("pn"), ratio("n", "d", 0).alias("r")
    ).collect()
    assert [r.p0 for r in rows] == [25.0, 0.0, 0.0, 0.0, 33.33]
    assert [r.pn for r in rows] == [25.0, None, None, None, 33.3]
    assert [r.r for r in rows] == [0.0, None, None, None, 0.0]


@pytest.mark.parametrize(
    "text,tax,spend,area,count",
    [
        ("R$ 1.234.567,89", 1234567.89, None, None, None),
        ("1.234,50", 1234.5, 1234.5, None, 123450),
        ("12,5", 12.5, 12.5, 12.5, 125),
        ("1234.56", 1234.56, 123456.0, 1234.56, 123456),
        ("1,234.56", 1.23456, 1.23456, None, 123456),
        ("abc", 0.0, None, None, None),
    ],
)
def test_number_parsers_fixture_table(spark, text, tax, spend, area, count):
    df = spark.createDataFrame([(text,)], "s string")
    r = df.select(
        parse_brl("s").alias("tax"), parse_amount("s").alias("spend"), parse_area("s").alias("area"),
        parse_count("s").alias("cnt"),
    ).first()
    assert r.tax == pytest.approx(tax)
    assert (r.spend is None and spend is None) or r.spend == pytest.approx(spend)
    assert (r.area is None and area is None) or r.area == pytest.approx(area)
    assert r.cnt == count


def test_numeric_amount_passthrough(spark):
    df = spark.createDataFrame([(7.0,)], "v double")
    assert df.select(parse_amount("v")).first()[0] == pytest.approx(70.0)  # text of 7.0 drops its dot
    assert df.select(parse_brl("v")).first()[0] == 7.0
    assert spark.createDataFrame([(None,)], "s string").select(parse_count("s")).first()[0] == 0


def test_biome_and_category_rules_in_order(spark):
    biomes = ["Amazon", "AMAZÔNIA LEGAL", "Mata Atlântica", "atlantic forest", "cerrado", "Other"]
    df = spark.createDataFrame([(b,) for b in biomes], "b string")
    assert [r[0] for r in df.select(normalise_by_rules("b", BIOME_RULES)).collect()] == [
        "Amazonia", "Amazonia", "Mata Atlantica", "Mata Atlantica", "Cerrado", "Other"
    ]
    cats = ["Saude", "Saúde", "Educacao", "Previdencia Social", "Defesa Nacional", "Assistencia Social",
            "Meio Ambiente", "Ciencia e Tecnologia", "Seguranca Publica", "Social Security"]
    df = spark.createDataFrame([(c,) for c in cats], "c string")
    assert [r[0] for r in df.select(normalise_by_rules("c", CATEGORY_RULES)).collect()] == [
        "Health", "Health", "Education", "Social Security", "Defense", "Social Assistance",
        "Environment", "Science & Technology", "Public Safety", "Public Safety",
    ]


def test_rules_sql_matches_column_expression(spark):
    cats = ["Saude", "Previdencia Social", "Social Security", "xyz", "Meio Ambiente"]
    df = spark.createDataFrame([(c,) for c in cats], "c string")
    spark_out = [r[0] for r in df.select(normalise_by_rules("c", CATEGORY_RULES)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT * FROM (VALUES " + ",".join(f"('{c}', {i})" for i, c in enumerate(cats)) + ") v(c, i)")
    sql_out = [r[0] for r in con.execute(f"SELECT {rules_sql('c', CATEGORY_RULES)} FROM t ORDER BY i").fetchall()]
    assert spark_out == sql_out


def test_state_upper(spark):
    df = spark.createDataFrame([("pa",), ("all",), ("Sao Paulo",)], "s string")
    assert [r[0] for r in df.select(normalise_state("s")).collect()] == ["PA", "ALL", "SAO PAULO"]


def test_sql_and_column_paths_agree(spark):
    from pyspark.sql import functions as F

    from strata.functions.numeric import change_pct

    rnd = random.Random(11)
    rows = [(rnd.uniform(-1e5, 1e5), rnd.choice([0.0, -1.0, None, rnd.uniform(0, 1e5)])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double")
    out = df.select(
        round_half_away("a", 2).alias("r_sql"), round_half_away(F.col("a"), 2).alias("r_col"),
        pct("a", "b", 2, 0.0).alias("p_sql"), pct(F.col("a"), F.col("b"), 2, 0.0).alias("p_col"),
        ratio("a", "b", 1).alias("q_sql"), ratio(F.col("a"), F.col("b"), 1).alias("q_col"),
        change_pct("a", "b", 1).alias("c_sql"), change_pct(F.col("a"), F.col("b"), 1).alias("c_col"),
    ).collect()
    for r in out:
        assert (r.r_sql, r.p_sql, r.q_sql, r.c_sql) == (r.r_col, r.p_col, r.q_col, r.c_col)


def test_rules_on_a_column_name_with_spaces(spark):
    df = spark.createDataFrame([("Saude publica",), ("outra",)], "`Funcao de Governo` string")
    out = [r[0] for r in df.select(normalise_by_rules("Funcao de Governo", CATEGORY_RULES)).collect()]
    assert out == ["Health", "outra"]
