"""Running totals, ranks and top-N over ranges against the window functions."""

import contextlib
import io
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import spread


def table(spark, seed, n=400):
    rnd = random.Random(seed)
    rows = [(rnd.choice(["hot", "hot", "hot", "b", None, f"k{rnd.randint(0, 9)}"]), rnd.choice([None, *range(rnd.choice([2, 6, 60]))]),
             None if rnd.random() < 0.1 else rnd.randint(-50, 50), i) for i in range(n)]
    return spark.createDataFrame(rows, "key string, at int, v int, i int").select("key", "at", F.col("v").cast("decimal(12,2)").alias("v"), "i").repartition(5)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed, ranges", [(1, 7), (2, 3), (3, 1), (4, 16)])
def test_running_total_and_previous(spark, seed, ranges):
    df = table(spark, seed)
    window = Window.partitionBy("key").orderBy("at")
    want = df.withColumn("total", F.sum("v").over(window))
    got = spread.running_total(df, ["key"], "at", "v", "total", ranges=ranges)
    assert got.columns == want.columns and got.schema["total"].dataType == want.schema["total"].dataType
    assert rows(got) == rows(want)
    by_row = Window.partitionBy("key").orderBy("i")
    want = df.withColumn("total", F.sum("v").over(by_row)).withColumn("before", F.lag("v").over(by_row))
    assert rows(spread.running_total(df, ["key"], "i", "v", "total", previous="before", ranges=ranges)) == rows(want)


@pytest.mark.parametrize("seed, ranges", [(5, 7), (6, 3), (7, 16)])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_and_top_n(spark, seed, ranges, descending):
    df = table(spark, seed)
    order = F.col("at").desc_nulls_last() if descending else F.col("at").asc_nulls_last()
    want = df.withColumn("place", F.rank().over(Window.partitionBy("key").orderBy(order)).cast("bigint"))
    assert rows(spread.rank(df, ["key"], "at", "place", descending, ranges)) == rows(want)
    for n in (1, 5, 1000):
        assert rows(spread.top_n(df, ["key"], "at", n, "place", descending, ranges)) == rows(want.where(F.col("place") <= n))


def test_a_hot_key_is_spread(spark):
    df = spark.range(20_000).select(F.lit("one").alias("key"), (F.col("id") % 10).cast("int").alias("at"), F.col("id").alias("v"))
    got = spread.running_total(df, ["key"], "at", "v", "total", ranges=8)
    assert got.agg(F.max("total")).first()[0] == sum(range(20_000))
    placed = spread._placed(df, ["key"], [F.col("at")], 8)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 6000
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        spread.rank(df, ["key"], "at", "place", ranges=8).explain(mode="formatted")
    assert "[_part#" in buf.getvalue()  # rows meet by range


def test_empty(spark):
    df = table(spark, 1).limit(0)
    assert spread.running_total(df, ["key"], "at", "v", "total", previous="p").count() == 0
    assert spread.top_n(df, ["key"], "at", 3).count() == 0


def test_trend_updates_equal_a_full_recompute(spark, scratch):
    from strata.operators.yearly import update_trend
    from strata.sources.versions import read_version, versions

    rnd = random.Random(3)
    facts = {(y, k): rnd.randint(1, 99) for y in range(2000, 2008) for k in ("a", "b", None) if rnd.random() < 0.8}
    path = scratch("trend")

    def frame(years):
        rows = [(y, k, v) for (y, k), v in facts.items() if y in years]
        return spark.createDataFrame(rows, "year int, k string, v int").select("year", "k", F.col("v").cast("decimal(12,2)").alias("v"))

    window, seen = Window.partitionBy("k").orderBy("year"), set()
    for years in ([2003, 2004], [2001, 2005], [2002], [2000, 2006, 2007], [2004], [2001]):
        for y in years:  # the facts of these years change, one key's end
            facts |= {(y, k): rnd.randint(1, 99) for k in ("a", "b")}
            facts.pop((y, rnd.choice(["a", None])), None)
        if years == [2004]:
            facts = {key: v for key, v in facts.items() if key[0] != 2004}
        seen |= set(years)
        got = update_trend(path, frame(years), ["k"], "v", years)
        want = frame(seen).withColumn("total", F.sum("v").over(window)).withColumn("before", F.lag("v").over(window))
        assert rows(got) == rows(want), years
    before = {f for f in read_version(spark, path).inputFiles() if "year=2000" in f}
    update_trend(path, frame([2005]), ["k"], "v", [2005])
    assert {f for f in read_version(spark, path).inputFiles() if "year=2000" in f} == before  # an earlier year's files stay
    assert len(versions(spark, path)) == 7
