import pytest
from pyspark.sql import functions as F

from strata.operators import QualityCheckFailed
from strata.plans import deforestation, medallion
from strata.sources.csv import write_csv
from strata.sources.csv import write_csv
from strata.sources.tables import read_table
from tests import fixtures as fx


def test_full_run_three_domains_and_cross(spark, scratch):
    root = scratch("lake")
    write_csv(fx.deforestation_raw(spark), f"{root}/raw/deforestation")
    out = medallion.run_deforestation(spark, f"{root}/raw/deforestation", root)
    assert out["failed"] == 0 and "gold_deforestation_by_biome" in out["views"]
    medallion.run_spending(spark, fx.spending_raw(spark), root)
    medallion.run_tax(spark, fx.tax_raw(spark), root)
    views = medallion.run_cross_domain(spark, root)["views"]
    assert len(views) == 6
    fb = {r.year: r for r in spark.sql("SELECT * FROM gold_fiscal_balance").collect()}
    assert fb[2024].irpf_covers_pct == 23.6
    ovs = {r.year: r for r in spark.sql("SELECT * FROM gold_deforestation_vs_spending").collect()}
    assert ovs[2024].spending_per_km2_deforested == 528785.0
    biome = {r.year: r for r in spark.sql("SELECT * FROM gold_deforestation_by_biome").collect()}
    assert biome[2024].cumulative_km2 == 294886.0
    assert "_computed_at" in spark.table("gold_deforestation_by_biome").columns


def test_year_backfill_keeps_other_years(spark, scratch):
    root = scratch("lake-backfill")
    medallion.run_deforestation(spark, fx.deforestation_raw(spark), root, audit=False)
    changed = fx.deforestation_raw(spark).where(F.col("year") == "2024").withColumn("area_km2", F.lit("7000"))
    medallion.run_deforestation(spark, changed, root, years=(2024, 2024), audit=False)
    silver = read_table(spark, medallion.Layout(root).silver("deforestation"))
    assert silver.count() == 57
    assert silver.where("year = 2024").agg(F.max("area_km2")).first()[0] == 7000.0
    biome = {r.year: r for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert biome[2024].area_km2 == 7000.0 and biome[2023].area_km2 == 9001.0


def test_gate_failure_raises_and_quarantine_written(spark, scratch):
    root = scratch("lake-gate")
    raw = spark.createDataFrame([("1990", "Amazon", "ALL", "5"), ("20x", "Amazon", "ALL", "5")],
                                "year string, biome string, state string, area_km2 string")
    with pytest.raises(QualityCheckFailed) as err:
        medallion.run_deforestation(spark, raw, root)  # 1990 is outside the silver years: silver is empty
    assert "silver.deforestation" not in str(err.value) or "row_count" in str(err.value)
    rejected = read_table(spark, medallion.Layout(root).rejected("deforestation"))
    assert [r._reject_reason for r in rejected.collect()] == ["bad_year"]


def test_incremental_runs_only_on_new_files(spark, scratch):
    from strata.sources.csv import write_csv

    root, landing = scratch("lake-inc"), scratch("landing-inc")
    raw = fx.deforestation_raw(spark)
    write_csv(raw.where("year < '2019'"), f"{landing}/d1")
    first = medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, audit=False)
    assert len(first) == 1
    assert medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, audit=False) == []
    write_csv(raw.where("year >= '2019'"), f"{landing}/d2")
    second = medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, audit=False)
    assert len(second) == 1
    silver = read_table(spark, medallion.Layout(root).silver("deforestation"))
    assert silver.count() == 57
    biome = {r.year: r for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert biome[2024].cumulative_km2 == 294886.0


def test_cli_run_and_query(spark, scratch, capsys):
    from strata.__main__ import main
    from strata.sources.csv import write_csv

    root, raw_dir = scratch("lake-cli"), scratch("raw-cli")
    write_csv(fx.deforestation_raw(spark), raw_dir)
    main(["run", "deforestation", "--raw", raw_dir, "--root", root])
    main(["query", "--root", root, "SELECT max(cumulative_km2) AS c FROM gold_deforestation_by_biome"])
    out = capsys.readouterr().out
    assert "294886.0" in out


def test_raw_columns_are_taken_by_header_name(spark, scratch):
    root, raw_dir = scratch("lake-order"), scratch("raw-order")
    reordered = fx.deforestation_raw(spark).select("area_km2", "state", "year", "biome")
    write_csv(reordered, raw_dir)
    medallion.run_deforestation(spark, raw_dir, root, audit=False)
    biome = {r.year: r for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert biome[2024].cumulative_km2 == 294886.0


def test_fail_fast_rejects_the_drop(spark, scratch):
    root = scratch("lake-failfast")
    raw = spark.createDataFrame([("2020", "Amazon", "ALL", "5"), ("20x", "Amazon", "ALL", "5")],
                                "year string, biome string, state string, area_km2 string")
    with pytest.raises(medallion.RejectedRowsError):
        medallion.run_deforestation(spark, raw, root, fail_fast=True)
    assert read_table(spark, medallion.Layout(root).rejected("deforestation")).count() == 1
    import os
    assert not os.path.exists(medallion.Layout(root).bronze("deforestation"))  # bronze untouched


def test_gate_results_observed_on_full_runs_scanned_on_backfills(spark, scratch):
    root = scratch("lake-gate-obs")
    full = medallion.run_deforestation(spark, fx.deforestation_raw(spark), root, audit=False)
    by = {(d["table_name"], d["check_name"]): d for d in full["details"]}
    assert by[("bronze.deforestation", "row_count")]["value"] == 57
    assert by[("silver.deforestation", "row_count")]["value"] == 57.0
    assert by[("silver.deforestation", "negative_areas")]["passed"]
    assert ("gold.deforestation_by_biome", "row_count") in by
    one = fx.deforestation_raw(spark).where("year = '2024'")
    back = medallion.run_deforestation(spark, one, root, years=(2024, 2024), audit=False)
    by = {(d["table_name"], d["check_name"]): d for d in back["details"]}
    assert by[("silver.deforestation", "row_count")]["value"] == 57.0  # the whole table, not the year


def test_incremental_backlog_in_bounded_batches(spark, scratch):
    root, landing = scratch("lake-backlog"), scratch("landing-backlog")
    raw = fx.deforestation_raw(spark)
    for i, cond in enumerate(["year < '2010'", "year >= '2010' AND year < '2020'", "year >= '2020'"]):
        write_csv(raw.where(cond).coalesce(1), f"{landing}/d{i}")
    runs = medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, max_files_per_batch=1,
                                     audit=False)
    assert len(runs) == 3
    biome = {r.year: r for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert biome[2024].cumulative_km2 == 294886.0


def test_cli_incremental_and_cross(spark, scratch, capsys):
    import json

    from strata.__main__ import main

    root, landing = scratch("lake-cli2"), scratch("landing-cli2")
    write_csv(fx.deforestation_raw(spark), f"{landing}/d0")
    main(["incremental", "deforestation", "--landing", f"{landing}/*", "--root", root])
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"batches": 1}
    medallion.run_spending(spark, fx.spending_raw(spark), root, audit=False)
    medallion.run_tax(spark, fx.tax_raw(spark), root, audit=False)
    main(["cross", "--root", root])
    views = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["views"]
    assert "gold_fiscal_balance" in views and "gold_deforestation_vs_spending" in views
    main(["query", "--root", root, "SELECT irpf_covers_pct FROM gold_fiscal_balance WHERE year = 2024"])
    assert "23.6" in capsys.readouterr().out


def test_errors_propagate(spark, scratch):
    """Nothing is swallowed: a missing drop or bad SQL fails the run instead of reporting 0 rows."""
    from pyspark.errors import AnalysisException

    from strata.sources.tables import run_sql

    with pytest.raises(AnalysisException):
        medallion.run_deforestation(spark, scratch("missing") + "/none/*.csv", scratch("lake-err"))
    with pytest.raises(AnalysisException):
        run_sql(spark, "SELECT no_such_column FROM {t}", frames={"t": spark.range(1)})


def test_rebalanced_bronze_gives_the_same_tables(spark, scratch):
    root = scratch("lake-rebalance")
    medallion.run_deforestation(spark, fx.deforestation_raw(spark), root, audit=False, rebalance_bronze=True)
    assert read_table(spark, medallion.Layout(root).bronze("deforestation")).count() == 57
    biome = {r.year: r for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert biome[2024].cumulative_km2 == 294886.0


def test_latin1_raw_drop(spark, scratch, tmp_path):
    import os

    from strata.__main__ import main

    root, raw_dir = scratch("lake-latin1"), scratch("raw-latin1")
    os.makedirs(raw_dir)
    with open(f"{raw_dir}/prodes.csv", "w", encoding="latin-1") as f:
        f.write("year,biome,state,area_km2\n2020,Amazônia,ALL,10\n2021,Amazônia,ALL,12\n")
    main(["run", "deforestation", "--raw", raw_dir, "--root", root, "--encoding", "ISO-8859-1"])
    biome = {r.year: r.biome for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert biome == {2020: "Amazonia", 2021: "Amazonia"}


@pytest.mark.parametrize("cap", [1, 2, None])
def test_years_over_several_files_do_not_depend_on_batches(spark, scratch, cap):
    """A year in several files keeps all its rows, whatever the batch size; later files add to earlier years."""
    root, landing = scratch("lake-split"), scratch("landing-split")
    raw = fx.deforestation_raw(spark)
    for i in range(3):
        write_csv(raw.where(F.pmod(F.crc32("state"), F.lit(3)) == i).coalesce(1), f"{landing}/d{i}")
    medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, max_files_per_batch=cap, audit=False)
    silver = read_table(spark, medallion.Layout(root).silver("deforestation"))
    assert silver.count() == 57
    late = spark.createDataFrame([("2024", "Amazon", "TO", "1"), ("x", "Amazon", "TO", "2"), ("2024", "Amazon", "RR", "NaN")], raw.schema)
    write_csv(late.coalesce(1), f"{landing}/late")
    medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, audit=False)
    assert read_table(spark, medallion.Layout(root).silver("deforestation")).count() == 58
    rejected = read_table(spark, medallion.Layout(root).rejected("deforestation")).collect()
    assert sorted(r._reject_reason for r in rejected) == ["bad_area_km2", "bad_year"]


def test_a_batch_without_a_readable_year_is_kept_as_rejects(spark, scratch):
    root, landing = scratch("lake-noyear"), scratch("landing-noyear")
    write_csv(spark.createDataFrame([("2020d", "Amazon", "PA", "1")], fx.deforestation_raw(spark).schema).coalesce(1), f"{landing}/d")
    assert medallion.run_incremental(spark, "deforestation", f"{landing}/*", root, audit=False) == []
    assert [r._reject_reason for r in read_table(spark, medallion.Layout(root).rejected("deforestation")).collect()] == ["bad_year"]


def test_run_if_changed_sees_a_file_published_again(spark, scratch):
    import os

    root, landing = scratch("lake-changed"), scratch("landing-changed")
    os.makedirs(landing)
    rows = [r for r in fx.deforestation_raw(spark).collect()]

    def publish(name, rows):
        with open(f"{landing}/{name}", "w") as f:
            f.write("year,biome,state,area_km2\n" + "".join(",".join(r) + "\n" for r in rows))

    publish("a.csv", rows)
    run = lambda: medallion.run_if_changed(spark, "deforestation", landing, root, audit=False)
    assert run()["changes"] == {"added": 1}
    assert run() is None
    publish("a.csv", rows)  # the same content again
    assert run() is None
    publish("a.csv", [(y, b, s, "7000" if (y, s) == ("2024", "ALL") else a) for y, b, s, a in rows])
    publish("b.csv", [("2025", "Amazon", "ALL", "5000")])
    assert run()["changes"] == {"changed": 1, "added": 1}
    gold = {r.year: r.area_km2 for r in read_table(spark, medallion.Layout(root).gold("deforestation_by_biome")).collect()}
    assert gold[2024] == 7000.0 and gold[2025] == 5000.0


def test_run_if_changed_hashes_files_over_the_bound(spark, scratch):
    import os

    root, landing = scratch("lake-large"), scratch("landing-large")
    os.makedirs(landing)

    def publish(area, at):
        with open(f"{landing}/a.csv", "w") as f:
            f.write(f"year,biome,state,area_km2\n2024,Amazon,ALL,{area}\n")
        os.utime(f"{landing}/a.csv", (at, at))

    run = lambda: medallion.run_if_changed(spark, "deforestation", landing, root, audit=False)
    publish(5000, 1_600_000_000)
    assert run()["changes"] == {"added": 1}
    publish(5000, 1_700_000_000)
    assert run() is None
    publish(6000, 1_600_000_000)
    assert run()["changes"] == {"changed": 1}


def test_amounts_a_sum_cannot_hold_are_rejected(spark, scratch):
    root = scratch("lake-amounts")
    base = [("2020", "Saude", "x", "10", "9"), ("2020", "Saude", "x", "1", "NaN"), ("2020", "Saude", "x", "1", "Infinity"),
            ("2020", "Saude", "x", "1", "2e16"), ("2020", "Saude", "x", "1", "100d"), ("9007199254740993", "Saude", "x", "1", "1")]
    raw = spark.createDataFrame(base, "year string, functional_category string, description string, budgeted_brl string, executed_brl string")
    medallion.run_spending(spark, raw, root, audit=False)
    (gold,) = read_table(spark, medallion.Layout(root).gold("spending_by_function")).collect()
    assert (gold.budgeted_brl, gold.executed_brl) == (10.0, 9.0)
    reasons = sorted(r._reject_reason for r in read_table(spark, medallion.Layout(root).rejected("spending")).collect())
    assert reasons == ["bad_executed_brl"] * 3 + ["bad_year", "range_executed_brl"]


def test_whole_numbers_are_read_exactly(spark):
    from strata.plans.common import typed_int, typed_long

    df = spark.createDataFrame([("9007199254740993",), ("-9223372036854775808",), ("12.5",), ("1e3",), ("12f",), ("99999999999999999999",), (" 7 ",), (None,)], "s string")
    got = [tuple(r) for r in df.select(typed_long("s"), typed_int("s")).collect()]
    assert got == [(9007199254740993, None), (-9223372036854775808, None), (12, 12), (1000, 1000), (None, None), (None, None), (7, 7), (None, None)]
