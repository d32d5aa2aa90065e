"""Versioned tables, the view catalogue and ordered output."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import medallion
from strata.sources import stores
from strata.sources.tables import read_ordered, write_ordered
from strata.sources.versions import CommitConflict, attach_views, catalogue, is_versioned, publish_views, read_version, vacuum, versions, write_version
from tests import fixtures as fx


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_a_dying_write_leaves_the_table_readable(spark, scratch):
    path = scratch("atomic")
    first = spark.createDataFrame([(1, 2020), (2, 2021)], "k int, year int")
    assert write_version(first, path, ["year"]) == 1
    dying = spark.range(4000).repartition(8).select(F.col("id").cast("int").alias("k"), F.lit(2020).alias("year")).withColumn(
        "k", F.when(F.col("k") == 3999, F.raise_error(F.lit("killed"))).otherwise(F.col("k")))
    with pytest.raises(Exception, match="killed"):
        write_version(dying, path, ["year"], overwrite="partitions")
    assert versions(spark, path) == [1] and rows(read_version(spark, path)) == [(1, 2020), (2, 2021)]
    assert len(os.listdir(f"{path}/data")) == 2  # the dead job's folder, which nobody reads
    gone = vacuum(spark, path)
    assert len(gone) == 1 and rows(read_version(spark, path)) == [(1, 2020), (2, 2021)]


def test_readers_keep_their_version(spark, scratch):
    path = scratch("pinned")
    write_version(spark.createDataFrame([(1, "02"), (2, "10")], "k int, code string"), path, ["code"])
    old = read_version(spark, path)
    write_version(spark.createDataFrame([(3, "02")], "k int, code string"), path, ["code"], overwrite="partitions")
    write_version(spark.createDataFrame([(4, "11")], "k int, code string"), path, ["code"])
    assert rows(old) == [(1, "02"), (2, "10")]
    assert rows(read_version(spark, path, 2)) == [(2, "10"), (3, "02")]
    assert rows(read_version(spark, path)) == [(4, "11")]
    assert len(vacuum(spark, path, keep=2)) == 0 and versions(spark, path) == [2, 3]  # version 2 still needs the first folder
    assert len(vacuum(spark, path)) == 2 and versions(spark, path) == [3]
    with pytest.raises(FileNotFoundError):
        read_version(spark, path, 2)


def test_versions_of_odd_tables(spark, scratch):
    path = scratch("odd [1] table")
    empty = spark.createDataFrame([], "k int, year int")
    write_version(empty, path, ["year"])
    assert is_versioned(spark, path) and read_version(spark, path).count() == 0 and read_version(spark, path).columns == ["k", "year"]
    write_version(spark.createDataFrame([(1, None), (2, 5)], "k int, year int"), path, ["year"], overwrite="partitions")
    assert sorted(read_version(spark, path).collect(), key=str) == sorted([(1, None), (2, 5)], key=str)
    write_version(spark.range(3), f"{path}/plain")
    assert rows(read_version(spark, f"{path}/plain")) == [(0,), (1,), (2,)]
    for bad in ({"overwrite": "some"}, {"overwrite": "partitions"}):
        with pytest.raises(ValueError):
            write_version(empty, path, **bad)
    with pytest.raises(ValueError):
        write_version(empty, path, ["k"], overwrite="partitions")
    with pytest.raises(FileNotFoundError):
        read_version(spark, scratch("nothing"))
    with pytest.raises(ValueError):
        vacuum(spark, path, keep=0)


def test_two_writers_of_one_version(spark, scratch, monkeypatch):
    path = scratch("race")
    write_version(spark.range(1), path)
    root = stores.qualified(spark, path)
    whole = stores.put_bytes

    def late(target, data):  # another writer commits the same version in between
        whole(target, data)
        whole(target, b'{"version": 2, "writer": "other", "partition_by": [], "schema": null, "parts": {}}')

    monkeypatch.setattr(stores, "put_bytes", late)
    with pytest.raises(CommitConflict):
        write_version(spark.range(2), path)
    assert stores.read_bytes(f"{root}/_versions/2.json").startswith(b'{"version": 2, "writer": "other"')


def test_views_outlive_the_session(spark, scratch):
    root = scratch("lake")
    write_version(spark.createDataFrame([(1, "a")], "k int, t string"), f"{root}/t")
    spark.createDataFrame([("02", 1)], "code string, v int").write.partitionBy("code").parquet(f"{root}/plain")
    plain = spark.read.schema("v int, code string").parquet(f"{root}/plain")
    assert publish_views(spark, root, {"v_t": (f"{root}/t", read_version(spark, f"{root}/t"))}) == ["v_t"]
    publish_views(spark, root, {"v_plain": (f"{root}/plain", plain)})
    assert sorted(catalogue(spark, root)) == ["v_plain", "v_t"]
    other = spark.newSession()
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        other.table("v_t")
    assert sorted(attach_views(other, root)) == ["v_plain", "v_t"]
    assert other.sql("SELECT t FROM v_t").first().t == "a" and other.sql("SELECT code FROM v_plain").first().code == "02"
    write_version(spark.createDataFrame([(1, "b")], "k int, t string"), f"{root}/t")
    assert other.sql("SELECT t FROM v_t").first().t == "a"  # as attached
    assert attach_views(other, root, ["v_t"]) == ["v_t"] and other.sql("SELECT t FROM v_t").first().t == "b"
    with pytest.raises(KeyError):
        attach_views(other, root, ["v_none"])
    assert catalogue(spark, scratch("no lake")) == {} and attach_views(other, scratch("no lake")) == []


def test_atomic_lake(spark, scratch):
    root = scratch("atomic-lake")
    L = medallion.Layout(root, atomic=True)
    medallion.run_deforestation(spark, fx.deforestation_raw(spark), root, audit=False, atomic=True)
    before = L.read(spark, L.gold("deforestation_by_biome"))
    want = rows(before)
    changed = fx.deforestation_raw(spark).where("year = '2024'").withColumn("area_km2", F.lit("7000"))
    medallion.run_deforestation(spark, changed, root, years=(2024, 2024), audit=False, atomic=True)
    assert rows(before) == want  # a reader of the first run
    assert L.read(spark, L.silver("deforestation")).count() == 57
    assert {r.year: r.area_km2 for r in L.read(spark, L.gold("deforestation_by_biome")).collect()}[2024] == 7000.0
    medallion.run_spending(spark, fx.spending_raw(spark), root, atomic=True)
    medallion.run_tax(spark, fx.tax_raw(spark), root)  # a plain domain in the same lake
    assert len(medallion.run_cross_domain(spark, root, atomic=True)["views"]) == 6
    other = spark.newSession()
    attach_views(other, root)
    assert {r.year: r.irpf_covers_pct for r in other.table("gold_fiscal_balance").collect()}[2024] == 23.6


def test_ordered_output(spark, scratch):
    path = scratch("ordered")
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("t"))
    write_ordered(df.repartition(6), path, [F.desc("t"), "k"], files=9)
    got = read_ordered(spark, path)
    assert [(r.t, r.k) for r in got.orderBy("_position").collect()] == sorted(((r.t, r.k) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert sorted(r._position for r in got.collect()) == list(range(5000))
    same = spark.range(3000).select(F.lit(1).alias("k"))
    write_ordered(same, path, ["k"], files=6)  # one value for all rows is spread over the files
    sizes = read_ordered(spark, path).withColumn("f", F.input_file_name()).groupBy(F.floor(F.col("_position") / 1000)).count().collect()
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 3 and sum(r["count"] for r in sizes) == 3000
    write_ordered(same.limit(0), path, ["k"])
    assert read_ordered(spark, path).count() == 0
