"""Domain runs over mixed drops, the landing index of incremental runs, encodings, gates from files, repeated expressions."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.functions.parse import parse_brl, parse_count, parse_year
from strata.plans import medallion
from strata.plans.common import typed_int, typed_long
from strata.sources.csv import string_schema, write_csv
from strata.sources.tables import read_table
from strata.streaming.incremental import ingest_new_files
from tests import fixtures as fx
from tests.conftest import SF_SMALL


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def test_tax_run_over_mixed_layouts(spark, scratch):
    root = scratch("mixed-tax")
    put(f"{root}/landing/a.csv", "﻿ano;faixa;quantidade;rendimento_tributavel;imposto_devido;uf\n2023;Até 2 SM;1.000;1.234,50;R$ 10,00;ALL\n2023;2 a 5 SM;2.000;2.000,00;20,00;ALL\n")
    put(f"{root}/landing/b.csv", 'year,bracket,note,count,Imposto Devido,Rendimento Tributável\n2024,"Até 2 SM","said ""x"",\nthen more",1500,"30,25","3000,5"\n')
    put(f"{root}/landing/c.csv", "ano;faixa;quantidade\n20xx;A;1\n2024;A\n2024;A;x\n;A;1\n")
    out = medallion.run_tax(spark, f"{root}/landing", f"{root}/lake", mixed=True, audit=False, run_id="r1")
    assert out["failed"] == 0
    L = medallion.Layout(f"{root}/lake")
    bronze = read_table(spark, L.bronze("tax"))
    assert sorted((r.year, r.income_bracket, r.num_declarations, r.taxable_income_brl, r.tax_due_brl) for r in bronze.collect()) == [
        (2023, "2 a 5 SM", 2000, 2000.0, 20.0), (2023, "Até 2 SM", 1000, 1234.5, 10.0), (2024, "Até 2 SM", 1500, 3000.5, 30.25)]
    assert {r._source_file.rsplit("/", 1)[1] for r in bronze.collect()} == {"a.csv", "b.csv"}
    bad = read_table(spark, L.rejected("tax"))
    assert sorted((r.run_id, r._reject_reason, r._raw_record) for r in bad.collect()) == [
        ("r1", "bad_count", '{"ano":"2024","faixa":"A","quantidade":"x"}'), ("r1", "bad_year", '{"ano":"20xx","faixa":"A","quantidade":"1"}'), ("r1", "malformed", "2024;A")]
    gold = {(r.year, r.income_bracket): r.total_tax_due for r in read_table(spark, L.gold("tax_by_bracket")).collect()}
    assert gold[2024, "Até 2 SM"] == 30.25 and gold[2023, "Até 2 SM"] == 10.0
    with pytest.raises(medallion.RejectedRowsError):
        medallion.run_tax(spark, f"{root}/landing", f"{root}/strict", mixed=True, fail_fast=True)


def test_cli_takes_mixed_folders(spark, scratch, capsys):
    from strata.__main__ import main

    root = scratch("mixed-cli")
    rows = fx.deforestation_raw(spark)
    write_csv(rows.where("year < '2020'"), f"{root}/landing/a", sep=";")
    write_csv(rows.where("year >= '2020'").select(F.col("area_km2").alias("Area"), F.col("year").alias("ano"), F.col("biome").alias("bioma"), F.col("state").alias("UF")), f"{root}/landing/b")
    main(["run", "deforestation", "--raw", f"{root}/landing/*", "--root", f"{root}/lake", "--mixed", "--atomic"])
    main(["query", "--root", f"{root}/lake", "SELECT count(*) AS n FROM gold_deforestation_by_biome WHERE year = 2024 AND cumulative_km2 = 294886.0"])
    assert "|1" in capsys.readouterr().out.replace(" ", "")


def test_batches_open_only_the_files_of_their_years(spark, scratch):
    root = scratch("dirty-years")
    rows = fx.deforestation_raw(spark)
    for name, years in (("a", (2001, 2010)), ("b", (2011, 2020)), ("c", (2021, 2024))):
        write_csv(rows.where(F.col("year").between(*map(str, years))).coalesce(1), f"{root}/landing/{name}")
    run = lambda: medallion.run_incremental(spark, "deforestation", f"{root}/landing/*", f"{root}/lake", audit=False)
    (first,) = run()
    assert first["files_opened"] == 3 and run() == []
    L = medallion.Layout(f"{root}/lake")
    stamp = lambda: {d: max(os.path.getmtime(f"{L.silver('deforestation')}/{d}/{f}") for f in os.listdir(f"{L.silver('deforestation')}/{d}"))
                     for d in os.listdir(L.silver("deforestation")) if d.startswith("year=")}
    before = stamp()
    # two years far apart: only their files are opened, only their partitions rewritten
    put(f"{root}/landing/d/late.csv", "year,biome,state,area_km2\n2012,Amazon,ALL,5.0\n2023,Amazon,ALL,7.0\nbad,Amazon,ALL,1\n")
    (second,) = run()
    assert second["years"] == [2012, 2023] and second["files_opened"] == 3
    sizes = {r.path: r.length for r in medallion.landing_index(spark, f"{root}/lake", "deforestation").collect()}
    opened = sum(n for p, n in sizes.items() if "/a/" not in p)
    assert second["bytes_opened"] == opened < sum(sizes.values())
    after = stamp()
    assert {d for d in after if after[d] != before.get(d)} == {"year=2012", "year=2023"}
    silver = read_table(spark, L.silver("deforestation"))
    want = rows.where("year IN ('2012', '2023')").count() + 2
    assert silver.where("year IN (2012, 2023)").count() == want
    index = medallion.landing_index(spark, f"{root}/lake", "deforestation")
    late = index.where(F.col("path").contains("late")).collect()
    assert sorted((str(r.year), r.rows) for r in late) == [("2012", 1), ("2023", 1), ("None", 1)] and len({r.digest for r in late}) == 1 and len(late[0].digest) == 64
    assert [r._reject_reason for r in read_table(spark, L.rejected("deforestation")).where("run_id = 'batch-1'").collect()] == ["bad_year"]


def test_incremental_runs_take_the_encoding(spark, scratch):
    root = scratch("latin1-drops")
    put(f"{root}/landing/a.csv", "year,functional_category,description,budgeted_brl,executed_brl\n2024,Saúde,ação,10.0,9.0\n", "latin-1")
    medallion.run_incremental(spark, "spending", f"{root}/landing", f"{root}/lake", encoding="ISO-8859-1", audit=False)
    silver = read_table(spark, medallion.Layout(f"{root}/lake").silver("spending")).collect()
    assert [(r.functional_category, r.description) for r in silver] == [("Health", "ação")]


def test_streams_read_quotes_as_batches_do(spark, scratch):
    root = scratch("stream-quotes")
    rows = [("1", 'says "hi", twice\nand again'), ("2", "plain")]
    write_csv(spark.createDataFrame(rows, "k string, t string"), f"{root}/landing/d0")
    ingest_new_files(spark, f"{root}/landing/*", string_schema(["k", "t"]), f"{root}/table", f"{root}/ckpt")
    assert sorted(map(tuple, read_table(spark, f"{root}/table").collect())) == rows


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_texts_are_parsed_once(spark):
    assert plan_of(E.queries()["q_json_items"](spark, SF_SMALL)).count("from_json") == 1
    assert plan_of(E.queries()["q_api_spending"](spark, SF_SMALL)).count("from_json") == 1
    assert plan_of(E.queries()["q_json_rejects"](spark, SF_SMALL)).count("from_json") == 0  # parsed into a table before
    money = plan_of(E.queries()["q_money_parse"](spark, SF_SMALL))
    assert money.count("format_number") <= 8  # four texts, twice each


def test_amounts_of_items_are_made_once(spark):
    plan = plan_of(E.queries()["q_api_spending"](spark, SF_SMALL))
    assert plan.count("schemaOfVariant(") <= 4 and plan.count("try_variant_get") <= 5  # those of one amount


def test_number_texts(spark):
    texts = ["1.234,56", "1,234.56", "1234.56", "R$ 1.000.000,5", "R$-7", "12,5", "1.2.3", "1,2,3", "", " 3 ", "12d", "NaN", "1e400", "1e5", "-.5", "5.", None, ".", ",", "9223372036854775808", "9223372036854775807", "2.5", "3.5", "1e3"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", "t", parse_brl("t", unparseable=None).alias("brl"), parse_count("t").alias("count"), parse_year("t").alias("year"), typed_long("t").alias("long"), typed_int("t").alias("int")).orderBy("i").collect()
    got = {r.t: r for r in rows}
    assert [got[t].brl for t in ("1.234,56", "1,234.56", "1234.56", "R$ 1.000.000,5", "R$-7", "12,5", "1.2.3", "1,2,3", "", " 3 ", "12d", "NaN", "1e400")] == [
        1234.56, 1.23456, 1234.56, 1000000.5, -7.0, 12.5, None, None, None, 3.0, None, None, None]
    assert [got[t]["count"] for t in ("1.234,56", "", None, " 3 ", ".", "12d")] == [123456, 0, 0, 3, None, None]
    assert [got[t].long for t in ("9223372036854775808", "9223372036854775807", "2.5", "3.5", "1e3", "5.", "-.5", "", "12d")] == [None, 9223372036854775807, 2, 4, 1000, 5, 0, None, None]
    assert [got[t].int for t in ("9223372036854775807", "1e5", "1e400")] == [None, 100000, None]


def test_check_files_gate_a_run(spark, scratch, tmp_path, capsys):
    from strata.__main__ import main
    from strata.operators import QualityCheckFailed, load_named_checks

    root = scratch("check-file")
    write_csv(fx.deforestation_raw(spark), f"{root}/raw")
    good = tmp_path / "good.sql"
    good.write_text("-- a note\n-- name: silver_rows\nSELECT count(*)\nFROM {silver};\n-- name: no_null_years\n-- expect: eq 0\nSELECT count(*) FROM {silver} WHERE year IS NULL;\n"
                    "-- name: gold_rows\n-- expect: gte 1\nSELECT count(*) FROM {deforestation_by_biome}\n")
    assert [(c["name"], c["op"], c["threshold"]) for c in load_named_checks(str(good))] == [("silver_rows", "gt", 0), ("no_null_years", "eq", 0), ("gold_rows", "gte", 1)]
    main(["run", "deforestation", "--raw", f"{root}/raw", "--root", f"{root}/lake", "--checks", str(good)])
    assert '"failed": 0' in capsys.readouterr().out
    bad = tmp_path / "bad.sql"
    bad.write_text("-- name: impossible\n-- expect: eq 0\nSELECT count(*) FROM {silver};\n-- name: broken\nSELECT nothing FROM {bronze};\n")
    with pytest.raises(QualityCheckFailed, match="2 of .* impossible .* broken"):
        medallion.run_deforestation(spark, f"{root}/raw", f"{root}/lake", audit=False, checks=str(bad))
