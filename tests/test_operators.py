import pytest
from pyspark.sql import functions as F

from strata.operators import (
    Check,
    QualityCheckFailed,
    assert_checks,
    count_rows,
    count_where,
    evaluate,
    evaluate_observation,
    observe_checks,
    rollup_sum,
    run_checks,
    split_valid,
    top_n,
    with_cumulative,
    with_prev,
    with_rank,
    with_share,
)
from strata.operators.join import allocate, outer_balance


def _toy(spark, rows):
    return spark.createDataFrame(rows, "year int, biome string, state string, area double")


def _sum_by_year(df):
    return {r.year: float(r.area) for r in df.collect()}


def test_rollup_modes_toy_case(spark):
    # 'ALL' row 10 and state rows 4 + 6 for the same key.
    df = _toy(spark, [(2020, "A", "ALL", 10.0), (2020, "A", "PA", 4.0), (2020, "A", "MT", 6.0),
                      (2021, "A", "PA", 3.0)])
    executed = _sum_by_year(rollup_sum(df, ["year", "biome"], "state", "area", mode="as_executed"))
    preferred = _sum_by_year(rollup_sum(df, ["year", "biome"], "state", "area", mode="prefer_rollup"))
    assert executed == {2020: 20.0, 2021: 3.0}
    assert preferred == {2020: 10.0, 2021: 3.0}


def test_rollup_as_executed_null_state_semantics(spark):
    with_marker = _toy(spark, [(2020, "A", "ALL", 10.0), (2020, "A", None, 5.0), (2021, "A", None, 7.0)])
    # 2021 holds only a NULL state: every row of the key is dropped, so the key disappears.
    assert _sum_by_year(rollup_sum(with_marker, ["year", "biome"], "state", "area", mode="as_executed")) == {2020: 10.0}
    # No rollup row anywhere: NOT IN over an empty set keeps every row, NULL state included.
    without = _toy(spark, [(2020, "A", "PA", 1.0), (2020, "A", None, 5.0)])
    assert _sum_by_year(rollup_sum(without, ["year", "biome"], "state", "area", mode="as_executed")) == {2020: 6.0}
    with pytest.raises(ValueError):
        rollup_sum(without, ["year"], "state", "area", mode="nope")


def test_cumulative_range_frame_includes_peers(spark):
    df = spark.createDataFrame([("k", 1, 1.0), ("k", 2, 2.0), ("k", 2, 3.0), ("k", 3, 4.0)], "k string, y int, v double")
    out = sorted((r.y, r.v, r.c) for r in with_cumulative(df, ["k"], "y", "v", "c").collect())
    assert out == [(1, 1.0, 1.0), (2, 2.0, 6.0), (2, 3.0, 6.0), (3, 4.0, 10.0)]


def test_prev_skips_gaps_and_rank_has_gaps(spark):
    df = spark.createDataFrame([("k", 2000, 1.0), ("k", 2003, 2.0)], "k string, y int, v double")
    assert sorted((r.y, r.p) for r in with_prev(df, ["k"], "y", "v", "p").collect()) == [(2000, None), (2003, 1.0)]
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", 5.0), (1, "c", 3.0), (1, "d", None)], "g int, s string, v double")
    ranks = {r.s: r.r for r in with_rank(df, ["g"], "v", "r").collect()}
    assert ranks == {"a": 1, "b": 1, "c": 3, "d": 4}
    top = {r.s for r in top_n(df, ["g"], "v", 1, "r").collect()}
    assert top == {"a", "b"}


@pytest.mark.parametrize("method", ["window", "join"])
def test_share_sums_to_100(spark, method):
    df = spark.createDataFrame([(2000, "a", 1.0), (2000, "b", 3.0), (2001, "a", 0.0)], "year int, c string, v double")
    out = {(r.year, r.c): r.s for r in with_share(df, ["year"], "v", "s", 2, 0.0, method=method).collect()}
    assert out == {(2000, "a"): 25.0, (2000, "b"): 75.0, (2001, "a"): 0.0}


def test_outer_balance_and_allocate(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "year int, x double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "year int, y double")
    rows = sorted(tuple(r) for r in outer_balance(a, b).collect())
    assert rows == [(1, 1.0, None), (2, 2.0, 5.0), (3, None, 6.0)]
    totals = spark.createDataFrame([(1, 100.0)], "year int, t double")
    weights = spark.createDataFrame([(1, "a", 1.0), (1, "b", 3.0)], "year int, m string, w double")
    out = {r.m: r.share for r in allocate(totals, weights, ["year"], "w", "t", "share").collect()}
    assert out == {"a": 25.0, "b": 75.0}


def test_split_valid_first_failed_reason(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None), (None, None)], "a int, b int")
    good, bad = split_valid(df, {"no_a": F.col("a").isNotNull(), "no_b": F.col("b").isNotNull()})
    assert good.count() == 1
    assert sorted(r._reject_reason for r in bad.collect()) == ["no_a", "no_a", "no_b"]


def test_quality_comparators_python_and_column_agree(spark):
    cases = [
        (1.0, "gt", 0), (0.0, "gt", 0), (0.0, "gte", 0), (1.0, "lt", 1), (0.5, "lte", 0.5), (2.0, "eq", 2),
        (1.0, "between", (1, 3)), (3.0, "between", (1, 3)), (3.5, "between", (1, 3)),
        (None, "not_null", 0), (0.0, "not_null", 0), (2.0, "not_null", 0), (None, "gt", 0),
    ]
    df = spark.createDataFrame([(1,)], "x int")
    for value, op, thr in cases:
        check = Check("c", F.lit(value).cast("double"), op, thr)
        got = run_checks(df, [check]).first().passed
        assert got == evaluate(value, op, thr), (value, op, thr)
    with pytest.raises(ValueError):
        Check("bad", F.lit(1), "approx", 1)
    with pytest.raises(ValueError):
        evaluate(1, "approx", 1)


def test_run_checks_one_scan_and_assert_lists_all_failures(spark):
    df = spark.createDataFrame([(1, -1.0), (2, None), (3, 5.0)], "id int, v double")
    checks = [
        Check("rows", count_rows(), "gt", 0),
        Check("negatives", count_where(F.col("v") < 0), "eq", 0),
        Check("nulls", count_where(F.col("v").isNull()), "eq", 0),
    ]
    report = run_checks(df, checks, "t")
    assert report.count() == 3
    with pytest.raises(QualityCheckFailed) as err:
        assert_checks(report)
    assert "negatives" in str(err.value) and "nulls" in str(err.value) and "2 of 3 checks" in str(err.value)
    ok = run_checks(df, [checks[0]], "t")
    assert assert_checks(ok)["passed"] == 1


def test_observe_checks_during_write(spark, scratch):
    df = spark.createDataFrame([(1, -1.0), (2, 3.0)], "id int, v double")
    checks = [Check("rows", count_rows(), "gt", 0), Check("neg", count_where(F.col("v") < 0), "eq", 0)]
    observed, obs = observe_checks(df, checks)
    observed.write.mode("overwrite").parquet(scratch("observe"))
    verdicts = {v["name"]: v["passed"] for v in evaluate_observation(obs, checks)}
    assert verdicts == {"rows": True, "neg": False}


def test_sql_checks_count_errors_as_failures(spark):
    from strata.operators import assert_details, run_sql_checks

    spark.createDataFrame([(1,), (2,)], "x int").createOrReplaceTempView("t_checks")
    details = run_sql_checks(spark, [
        {"name": "rows", "sql": "SELECT count(*) FROM t_checks"},                      # default gt 0
        {"name": "max_le_1", "sql": "SELECT max(x) FROM t_checks", "op": "lte", "threshold": 1},
        {"name": "broken", "sql": "SELECT count(*) FROM no_such_table"},
        {"name": "range", "sql": "SELECT min(x) FROM t_checks", "op": "between", "threshold": [1, 2]},
    ])
    assert [d["passed"] for d in details] == [True, False, False, True]
    assert "error" in details[2]
    with pytest.raises(QualityCheckFailed) as err:
        assert_details(details)
    assert "max_le_1" in str(err.value) and "broken" in str(err.value)


def test_named_check_file(spark, tmp_path):
    from strata.operators import assert_details, load_named_checks, run_sql_checks

    spark.createDataFrame([(2020, 5.0), (2021, None)], "year int, area double").createOrReplaceTempView("silver_x")
    f = tmp_path / "checks.sql"
    f.write_text(
        "-- Checks for the silver table\n\n"
        "-- Row count\n-- name: row_count\nSELECT count(*) FROM IDENTIFIER(:silver);\n\n"
        "-- name: null_years\nSELECT count(*)\nFROM IDENTIFIER(:silver)\nWHERE year IS NULL;\n"
    )
    checks = load_named_checks(str(f))
    assert [c["name"] for c in checks] == ["row_count", "null_years"]
    checks[1].update(op="eq", threshold=0)
    details = run_sql_checks(spark, checks, args={"silver": "silver_x"})
    assert [d["passed"] for d in details] == [True, True]
    assert assert_details(details)["passed"] == 2


def test_prev_period_is_null_across_gaps(spark):
    from strata.operators import with_prev_period

    df = spark.createDataFrame([("k", 2000, 1.0), ("k", 2001, 2.0), ("k", 2003, 4.0), ("j", 2001, 9.0)],
                               "k string, y int, v double")
    out = sorted((r.k, r.y, r.p) for r in with_prev_period(df, ["k"], "y", "v", "p").collect())
    assert out == [("j", 2001, None), ("k", 2000, None), ("k", 2001, 1.0), ("k", 2003, None)]


def test_as_executed_ignores_rollup_rows_with_null_keys(spark):
    """A rollup row with a NULL key is not in the subquery's set: with no other, every row is kept."""
    rows = [(2020, None, "ALL", 10.0), (2020, "Cerrado", None, 5.0), (2020, "Cerrado", "PA", 3.0)]
    df = spark.createDataFrame(rows, "year int, biome string, state string, v double")
    got = {r.biome: float(r.v) for r in rollup_sum(df, ["year", "biome"], "state", "v", mode="as_executed").collect()}
    assert got == {None: 10.0, "Cerrado": 8.0}
    whole = df.union(spark.createDataFrame([(2021, "Cerrado", "ALL", 1.0)], df.schema))
    got = {(r.year, r.biome): float(r.v) for r in rollup_sum(whole, ["year", "biome"], "state", "v", mode="as_executed").collect()}
    assert got == {(2020, None): 10.0, (2020, "Cerrado"): 3.0, (2021, "Cerrado"): 1.0}
