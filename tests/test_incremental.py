from pyspark.sql import functions as F

from strata.sources.csv import string_schema, write_csv
from strata.sources.tables import read_table
from strata.streaming import diff_snapshots, ingest_new_files, process_new_files
from strata.streaming.incremental import changed_files, file_state


def test_available_now_processes_each_file_once(spark, scratch):
    root = scratch("stream")
    landing, target, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_ckpt"
    schema = string_schema(["id", "year"])
    drop1 = spark.createDataFrame([("1", "2020"), ("2", "2021")], "id string, year string")
    write_csv(drop1, f"{landing}/d1")
    cast = lambda df: df.select(F.col("id").cast("int").alias("id"), F.col("year").cast("int").alias("year"))
    ingest_new_files(spark, f"{landing}/*", schema, target, ckpt, transform=cast, partition_by=["year"])
    assert read_table(spark, target).count() == 2
    # A rerun with no new file does nothing.
    ingest_new_files(spark, f"{landing}/*", schema, target, ckpt, transform=cast, partition_by=["year"])
    assert read_table(spark, target).count() == 2
    write_csv(spark.createDataFrame([("3", "2021")], "id string, year string"), f"{landing}/d2")
    ingest_new_files(spark, f"{landing}/*", schema, target, ckpt, transform=cast, partition_by=["year"])
    assert sorted(r.id for r in read_table(spark, target).collect()) == [1, 2, 3]


def test_foreach_batch_sees_only_new_rows(spark, scratch):
    root = scratch("fb")
    landing, ckpt = f"{root}/landing", f"{root}/_ckpt"
    seen = []
    schema = string_schema(["id"])
    write_csv(spark.createDataFrame([("1",)], "id string"), f"{landing}/d1")
    process_new_files(spark, f"{landing}/*", schema, ckpt, lambda df, bid: seen.append(df.count()))
    write_csv(spark.createDataFrame([("2",), ("3",)], "id string"), f"{landing}/d2")
    process_new_files(spark, f"{landing}/*", schema, ckpt, lambda df, bid: seen.append(df.count()))
    assert [n for n in seen if n] == [1, 2]


def test_diff_snapshots(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "k int, s string, v double")
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 0.0), (4, "d", 4.0)], "k int, s string, v double")
    out = {r.k: r.change_type for r in diff_snapshots(old, new, ["k"]).collect()}
    assert out == {1: "unchanged", 2: "changed", 3: "removed", 4: "added"}


def test_failed_batch_is_retried_on_the_next_run(spark, scratch):
    """The checkpoint commits only after the batch succeeds, so a failed run is not skipped."""
    import pytest

    root = scratch("retry")
    landing, ckpt = f"{root}/landing", f"{root}/_ckpt"
    schema = string_schema(["id"])
    write_csv(spark.createDataFrame([("1",), ("2",)], "id string"), f"{landing}/d1")

    def failing(df, batch_id):
        raise RuntimeError("sink unavailable")

    with pytest.raises(Exception):
        process_new_files(spark, f"{landing}/*", schema, ckpt, failing)
    seen = []
    process_new_files(spark, f"{landing}/*", schema, ckpt, lambda df, bid: seen.append(df.count()))
    assert seen == [2]


def test_microsecond_changes_are_changes(spark):
    old = spark.sql("SELECT 1 AS k, TIMESTAMP '2020-01-01 00:00:00.000001' AS t, CAST(NULL AS STRING) AS s UNION ALL SELECT 2, TIMESTAMP '2020-01-01', NULL")
    new = spark.sql("SELECT 1 AS k, TIMESTAMP '2020-01-01 00:00:00.000002' AS t, CAST(NULL AS STRING) AS s UNION ALL SELECT 2, TIMESTAMP '2020-01-01', NULL")
    assert {r.k: r.change_type for r in diff_snapshots(old, new, ["k"]).collect()} == {1: "changed", 2: "unchanged"}


def test_nulls_do_not_swap_between_columns(spark):
    old = spark.createDataFrame([(1, "a", None)], "k int, x string, y string")
    new = spark.createDataFrame([(1, None, "a")], "k int, x string, y string")
    assert diff_snapshots(old, new, ["k"]).first().change_type == "changed"


def test_files_over_the_bound_go_by_content(spark, scratch, monkeypatch):
    import hashlib
    import os

    from strata.streaming import incremental

    monkeypatch.setattr(incremental, "PIECE_BYTES", 3)
    root = scratch("digests")
    os.makedirs(f"{root}/landing")
    text = {"small": b"abc", "alike": b"0123456789", "other, too": b"x" * 20, "gone": b"y" * 20}

    def put(name, content, at):
        with open(f"{root}/landing/{name}", "wb") as f:
            f.write(content)
        os.utime(f"{root}/landing/{name}", (at, at))

    for name, content in text.items():
        put(name, content, 1_600_000_000)
    file_state(spark, f"{root}/landing").write.parquet(f"{root}/state")
    before = spark.read.parquet(f"{root}/state")
    assert {r.path.rsplit("/", 1)[1]: (r.length, r.digest) for r in before.collect()} == {n: (len(c), hashlib.sha256(c).hexdigest()) for n, c in text.items()}
    put("alike", text["alike"], 1_700_000_000)  # the same bytes, later
    put("other, too", b"z" * 20, 1_600_000_000)  # other bytes of the same length and time
    os.remove(f"{root}/landing/gone")
    put("new", b"n" * 9, 1_600_000_000)
    got = {r.path.rsplit("/", 1)[1]: r.change for r in changed_files(file_state(spark, f"{root}/landing"), before).collect()}
    assert got == {"other, too": "changed", "gone": "removed", "new": "added"}


def test_published_files_are_many_and_the_same_again(spark, scratch):
    import hashlib
    import os

    from strata.sources.csv import publish_csv

    root = scratch("published")
    rows = spark.range(2000).selectExpr("id AS k", "id % 7 AS v")
    content = lambda: {f: hashlib.sha256(open(f"{root}/{f}", "rb").read()).digest() for f in os.listdir(root) if f.endswith(".csv")}  # noqa: E731, SIM115
    publish_csv(rows, root, "F", "k", 8)
    first = content()
    assert len(first) >= 8 and max(os.path.getsize(f"{root}/{f}") for f in first) < sum(os.path.getsize(f"{root}/{f}") for f in first) / 4
    publish_csv(rows.orderBy(F.desc("k")), root, "F", "k", 8)
    assert content() == first
