import os

import pytest
from pyspark.sql import functions as F

from strata.sources import (
    explode_items,
    explode_series,
    harmonise_deforestation,
    harmonise_tax,
    read_csv,
    read_json_items,
    read_table,
    register_views,
    run_sql,
    sniff_delimiter,
    sql_text,
    write_table,
)
from strata.sources.tables import create_path_view


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding) as f:
        f.write(text)


def test_static_vs_dynamic_overwrite(spark, scratch):
    path = scratch("table")
    df = spark.createDataFrame([(2019, 1.0), (2020, 2.0), (2021, 3.0)], "year int, v double")
    write_table(df, path, partition_by=["year"])
    one = spark.createDataFrame([(2020, 9.0)], "year int, v double")
    write_table(one, path, partition_by=["year"], overwrite="partitions")
    got = sorted(tuple(r) for r in read_table(spark, path, columns=["year", "v"]).collect())
    assert got == [(2019, 1.0), (2020, 9.0), (2021, 3.0)]
    write_table(one, path, partition_by=["year"], overwrite="all")
    assert sorted(tuple(r) for r in read_table(spark, path, columns=["year", "v"]).collect()) == [(2020, 9.0)]
    with pytest.raises(ValueError):
        write_table(one, path, overwrite="some")


def test_partition_schema_keeps_leading_zero(spark, scratch):
    path = scratch("codes")
    write_table(spark.createDataFrame([("02", 1)], "code string, v int"), path, partition_by=["code"])
    assert read_table(spark, path).first().code == 2  # inferred
    assert read_table(spark, path, schema="v int, code string").first().code == "02"


def test_messy_tax_csv_with_bom_semicolon_and_aliases(spark, scratch):
    root = scratch("tax-raw")
    text = (
        "﻿ano;Faixa de Renda;Quantidade de Declarações;Rendimento Tributável;imposto_devido;UF\n"
        "2020;  Ate 2 SM ;1.234;R$ 1.234.567,89;12,5;sp\n"
        "2020;;10;1;1;\n"
        "2021;2 a 5 SM;;abc;1234.56;\n"
        "x;3 a 5 SM;5;1;1;\n"
    )
    _write(f"{root}/a.csv", text)
    assert sniff_delimiter(spark, f"{root}/a.csv") == ";"
    raw = read_csv(spark, f"{root}/a.csv", sep=";")
    assert raw.columns[0] == "ano"  # byte-order mark dropped
    good, bad = harmonise_tax(raw)
    rows = sorted((r.year, r.income_bracket, r.state, r.num_declarations, r.taxable_income_brl, r.tax_due_brl)
                  for r in good.collect())
    assert rows == [
        (2020, "Ate 2 SM", "sp", 1234, 1234567.89, 12.5),
        (2021, "2 a 5 SM", "ALL", 0, 0.0, 1234.56),
    ]
    assert [r._reject_reason for r in bad.collect()] == ["bad_year"]


def test_deforestation_aliases_defaults(spark, scratch):
    root = scratch("def-raw")
    _write(f"{root}/a.csv", "Year;Area;uf\n2020;12,5;PA\n2021;3;\n;4;PA\n")
    good, _ = harmonise_deforestation(read_csv(spark, f"{root}/a.csv", sep=sniff_delimiter(spark, f"{root}/a.csv")))
    assert sorted(tuple(r) for r in good.collect()) == [(2020, "Amazon", "PA", 12.5), (2021, "Amazon", "ALL", 3.0)]


def test_comma_csv_sniff(spark, scratch):
    root = scratch("comma")
    _write(f"{root}/b.csv", "year,bracket,count\n2020,x,1\n")
    assert sniff_delimiter(spark, f"{root}/b.csv") == ","


def test_json_items_defaults_and_types(spark, scratch):
    root = scratch("json")
    _write(f"{root}/p1.json", '{"items": [{"coluna": "Saude", "rotulo": "r", "valor": "1.234,50"},'
                              ' {"coluna": "X", "valor": 7.5}, {"valor": 3}, {}]}')
    _write(f"{root}/p2.json", '{"items": []}')
    rows = sorted((r.category, r.description, r.amount) for r in read_json_items(spark, root).collect())
    assert rows == [("", "", 0.0), ("", "", 3.0), ("Saude", "r", 1234.5), ("X", "", 7.5)]


def test_explode_series(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0, 3.0])], "k string, vals array<double>")
    out = [(r.k, r.year, r.value) for r in explode_series(df, ["k"], "vals", 2000).orderBy("year").collect()]
    assert out == [("a", 2000, 1.0), ("a", 2001, 2.0), ("a", 2002, 3.0)]


def test_run_sql_binds_parameters_and_frames(spark, tmp_path):
    df = spark.createDataFrame([(2019, 1.0), (2020, 2.0)], "year int, v double")
    out = run_sql(spark, "SELECT sum(v) AS s FROM {t} WHERE year >= :y", args={"y": 2020}, frames={"t": df})
    assert out.first().s == 2.0
    register_views(spark, {"v_years": df})
    out = run_sql(spark, "SELECT count(*) AS n FROM IDENTIFIER(:tbl)", args={"tbl": "v_years"})
    assert out.first().n == 2
    sql_file = tmp_path / "q.sql"
    sql_file.write_text("SELECT 1 AS one")
    assert sql_text(spark, sql_file) == "SELECT 1 AS one"
    assert run_sql(spark, sql_file).first().one == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sql_text(spark, tmp_path / "missing.sql")
    with pytest.raises(ValueError):
        sql_text(spark, " ")


def test_path_view(spark, scratch):
    path = scratch("view")
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(path)
    create_path_view(spark, "v_path", path)
    assert spark.sql("SELECT sum(x) AS s FROM v_path").first().s == 3


def test_read_landing_groups_files_by_layout(spark, scratch):
    from strata.sources import group_layouts, read_landing

    root = scratch("landing")
    _write(f"{root}/2020.csv", "﻿ano;faixa;quantidade;uf\n2020;A;1.000;sp\n")
    _write(f"{root}/2021.csv", "ano;faixa;quantidade;uf\n2021;B;7;\n")
    _write(f"{root}/2022.csv", "year,bracket,count\n2022,C,3\n,D,4\n")
    layouts = group_layouts(spark, root)
    assert sorted((sep, len(files)) for (sep, _), files in layouts.items()) == [(",", 1), (";", 2)]
    good, bad = read_landing(spark, root, harmonise_tax)
    rows = sorted((r.year, r.income_bracket, r.state, r.num_declarations) for r in good.collect())
    assert rows == [(2020, "A", "sp", 1000), (2021, "B", "ALL", 7), (2022, "C", "ALL", 3)]
    assert {r._source_file.rsplit("/", 1)[-1] for r in good.collect()} == {"2020.csv", "2021.csv", "2022.csv"}
    assert bad.count() == 0


def test_rebalanced_partitioned_write(spark, scratch):
    path = scratch("rebalanced")
    df = spark.range(1000).select((F.col("id") % 3).cast("int").alias("year"), "id")
    write_table(df, path, partition_by=["year"], rebalance=True, sort_by=["id"])
    assert read_table(spark, path).groupBy("year").count().count() == 3
    assert read_table(spark, path).count() == 1000


def test_api_items_reject_unreadable_amounts(spark):
    from strata.plans import spending

    docs = spark.createDataFrame(
        [('{"year": 2020, "items": [{"coluna": "Saude", "valor": "1.234,5"}, {"coluna": "Saude", "valor": "x,y"}]}',)],
        "value string",
    )
    items = explode_items(docs, "value", fields={"year": "int"})
    raw, rejected = spending.api_items_to_raw(items)
    assert [(r.year, r.functional_category, r.budgeted_brl) for r in raw.collect()] == [(2020, "Saude", 1234.5)]
    assert [r._reject_reason for r in rejected.collect()] == ["bad_amount"]


def test_read_csv_keeps_malformed_lines(spark, scratch):
    root = scratch("corrupt")
    _write(f"{root}/a.csv", "year,area\n2020,1.5\n2021,abc\n2022\n")
    df = read_csv(spark, f"{root}/a.csv", schema="year int, area double", corrupt_column="_corrupt")
    rows = sorted((r.year, r.area, r._corrupt) for r in df.collect())
    assert rows[0] == (2020, 1.5, None)
    assert rows[1][0] == 2021 and rows[1][2] == "2021,abc"
    assert rows[2][0] == 2022 and rows[2][2] == "2022"


def test_bracket_and_state_strip_all_whitespace(spark):
    raw = spark.createDataFrame([("2020", "\t Ate 2 SM \t", " sp\t")], "ano string, faixa string, uf string")
    good, _ = harmonise_tax(raw)
    r = good.first()
    assert (r.income_bracket, r.state) == ("Ate 2 SM", "sp")


def test_read_landing_latin1_headers(spark, scratch):
    from strata.sources import read_landing

    root = scratch("latin1")
    _write(f"{root}/a.csv", "ano;Faixa de Renda;Quantidade de Declarações;Imposto Devido\n2020;A;12;1,5\n",
           encoding="latin-1")
    good, _ = read_landing(spark, root, harmonise_tax, encoding="ISO-8859-1")
    assert [(r.year, r.income_bracket, r.num_declarations, r.tax_due_brl) for r in good.collect()] == [
        (2020, "A", 12, 1.5)
    ]


def test_quoted_csv_round_trip(spark, scratch):
    """Delimiters, quotes and line breaks inside fields survive; records with a wrong field count keep their text."""
    from strata.sources import write_csv

    root = scratch("quoted")
    rows = [("a", 'He said "hi", ok', "10"), ("b", "two\nlines", "11"), ("c", "plain", "12"), ("d", 'ends with "', None)]
    write_csv(spark.createDataFrame(rows, "k string, t string, v string"), f"{root}/w")
    back = read_csv(spark, f"{root}/w", schema="k string, t string, v string")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    _write(f"{root}/r/a.csv", 'k,t,v\n1,"x, ""y""",9\n2,too,many,fields\n3,short\n4,"a\nb",5\n')
    got = read_csv(spark, f"{root}/r", schema="k string, t string, v string", corrupt_column="_corrupt").collect()
    assert sorted((r.k, r._corrupt is None) for r in got) == [("1", True), ("2", False), ("3", False), ("4", True)]
    assert {r.t for r in got if r._corrupt is None} == {'x, "y"', "a\nb"}
    with pytest.raises(Exception):
        read_csv(spark, f"{root}/r", schema="t string, k string, v string").collect()


def test_sniff_reads_the_first_two_kilobytes(spark, scratch):
    root = scratch("sniff")
    _write(f"{root}/a.csv", "x,y\n" * 70 + "a;b\n")
    assert sniff_delimiter(spark, f"{root}/a.csv") == ";"
    _write(f"{root}/b.csv", "x,y\n" * 700 + "a;b\n")
    assert sniff_delimiter(spark, f"{root}/b.csv") == ","


def test_landing_takes_any_file_name(spark, scratch):
    from strata.sources import read_landing

    root = scratch("names")
    for i, name in enumerate(["prodes 2020.csv", "a[1].csv", "50%.csv", "b{x,y}.csv", "c*?.csv"]):
        _write(f"{root}/{name}", f"ano;faixa;quantidade;uf\n20{10 + i};A;{i};sp\n")
    good, _ = read_landing(spark, root, harmonise_tax)
    assert sorted((r.year, r.num_declarations) for r in good.collect()) == [(2010 + i, i) for i in range(5)]


def test_unreadable_payloads_are_kept(spark):
    from strata.sources.json_items import rejected_payloads

    docs = [(1, '{"year": 2020, "items": [{"coluna": "A", "valor": 1}]}'), (2, "not json"), (3, '{"year": 2020, "items": [{"colu'),
            (4, '{"year": "x", "items": [{"coluna": "B", "valor": 2}]}'), (5, '{"year": 2021}'), (6, '{"year": 2021, "items": []}'), (7, None)]
    df = spark.createDataFrame(docs, "k int, value string")
    items = explode_items(df, "value", keep=["k"], fields={"year": "int"}).collect()
    assert [(r.k, r.year, r.category) for r in items] == [(1, 2020, "A")]
    bad = {r.k: r._reject_reason for r in rejected_payloads(df, "value", keep=["k"], fields={"year": "int"}).collect()}
    assert bad == {2: "unreadable", 3: "unreadable", 4: "no_year", 5: "no_items", 7: "unreadable"}


def test_partitioned_writes_do_not_hold_their_rows(spark, scratch, monkeypatch):
    from pyspark.sql import DataFrameWriter

    key = "spark.sql.maxConcurrentOutputFileWriters"
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(type(spark.range(1)), "sortWithinPartitions", lambda self, *a: pytest.fail("rows are sorted"))
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda self, *a, f=type(spark.range(1)).hint: (seen.append(a), f(self, *a))[1])
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(spark.conf.get(key)), write(self, *a, **k))[1])
    before, parts = spark.conf.get(key, None), spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(0, 5000, 1, 2).select("id", (F.col("id") % 50).alias("year"))
    spark.conf.set("spark.sql.shuffle.partitions", "900")
    try:
        for rebalance in (False, True):  # 50 values: more than a task writes side by side
            path = scratch("not-sorted")
            write_table(rows, path, ["year"], rebalance=rebalance)
            assert sorted(map(tuple, read_table(spark, path).select("id", "year").collect())) == sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert [x for x in seen if isinstance(x, str)] == ["32", "32"] and ("rebalance", 200, "year") in seen
    assert spark.conf.get(key, None) == before
