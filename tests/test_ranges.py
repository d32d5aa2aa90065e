"""The ranged reader of delimited text against the whole-file reader, and mixed landing folders."""

import contextlib
import io
import os
import random
import re

import pytest

from pyspark.sql import functions as F

from strata.sources import read_csv, read_landing, write_csv
from strata.sources import ranges
from strata.sources.harmonise import harmonise_tax
from strata.sources.ranges import fields_of, file_heads, read_columns, record_bounds


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())


def machine(text, sep):
    """(records as (start, end), ends inside quotes), one character at a time."""
    out, start, state, i = [], 0, "field", 0
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if c == '"':
                if text[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    state = "plain"
        elif c == "\n":
            out.append((start, i + 1))
            start, state = i + 1, "field"
        elif c == sep:
            state = "field"
        elif state == "field":
            state = "quoted" if c == '"' else "plain"
        i += 1
    return out + ([(start, len(text))] if start < len(text) else []), state == "quoted"


def line_start(text, at):
    if at == 0:
        return 0
    found = text.find("\n", at - 1)
    return len(text) if found < 0 else found + 1


def test_record_bounds_and_their_composition():
    rnd = random.Random(1)
    for _ in range(5000):
        text = "".join(rnd.choice('ab,,""\n\n;') for _ in range(rnd.randint(0, 40)))
        want, is_open = machine(text, ",")
        starts, ends, quoted, found_open = record_bounds(text.encode(), ",", False)
        assert list(zip(starts.tolist(), ends.tolist())) == want and found_open == is_open, text
        assert [('"' in text[s:e]) for s, e in want] == quoted.tolist(), text
        step, inside, got = rnd.randint(1, 9), False, []
        for lo in range(0, len(text), step):
            a = line_start(text, lo)
            b = max(a, line_start(text, min(lo + step, len(text))))
            if a < b:
                starts, _, _, inside = record_bounds(text[a:b].encode(), ",", inside)
                got += [a + s for s in starts.tolist()]
        assert got == [s for s, _ in want], (text, step)


def test_fields():
    assert fields_of('a,"b ""c"" d",', ",") == ["a", 'b "c" d', None]
    assert fields_of('"",x"y,"a"b', ",") == [None, 'x"y', '"a"b']
    assert fields_of('"two\nlines";2', ";") == ["two\nlines", "2"]


@pytest.mark.parametrize("seed", range(4))
def test_ranges_read_what_the_whole_file_reader_reads(spark, scratch, seed):
    rnd = random.Random(seed)
    root = scratch("random-csv")
    pieces = ["a", "é", "0", " ", ",", '"', "\n", "x y", "\r\n"]
    rows = [[None if rnd.random() < 0.1 else "".join(rnd.choices(pieces, k=rnd.randint(0, 6))) for _ in range(3)] for _ in range(40)]
    lines = ["k,t,v"]
    for row in rows:
        quoted = [("" if f is None else '"' + f.replace('"', '""') + '"' if f == "" or re.search('[,"\n\r]', f) or rnd.random() < 0.3 else f) for f in row]
        lines.append(",".join(quoted[: rnd.choice([3, 3, 3, 2])]) + ("" if rnd.random() < 0.95 else ",more"))
        if rnd.random() < 0.05:
            lines.append("")
    put(f"{root}/a.csv", "\n".join(lines) + ("\n" if seed % 2 else ""))
    want = read_csv(spark, f"{root}/a.csv", schema="k string, t string, v string", corrupt_column="_corrupt_record").collect()
    key = lambda r: tuple((x is None, x or "") for x in r)
    good = lambda rs: sorted(((r.k, r.t, r.v) for r in rs if r._corrupt_record is None), key=key)
    for size in (37, 300, 1 << 20):
        got = read_columns(spark, f"{root}/a.csv", ["k", "t", "v"], range_bytes=size).collect()
        assert good(got) == good(want), size
        assert sum(r._corrupt_record is not None for r in got) == sum(r._corrupt_record is not None for r in want)


def test_one_file_is_read_by_many_tasks(spark, scratch):
    root = scratch("one-file")
    put(f"{root}/a.csv", "k,t\n" + "".join(f'{i},"line {i}\nand ""more"""\n' for i in range(5000)))
    df = read_columns(spark, root, ["t", "k"], range_bytes=4096)
    rows = df.collect()
    assert {(r.k, r.t) for r in rows} == {(str(i), f'line {i}\nand "more"') for i in range(5000)} and len(rows) == 5000
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 1500 and len(sizes) > 10


def test_heads_read_a_bounded_part_of_each_file(spark, scratch):
    root = scratch("heads")
    put(f"{root}/a.csv", "﻿ano;uf\n" + "2020;PA\n" * 200_000)
    put(f"{root}/b.csv", "year,state\n2020,PA\n")
    put(f"{root}/c.csv", '"a\nb",' + ",".join(f"column {i}" for i in range(900)) + "\n1\n")
    put(f"{root}/d.csv", "único;ano\n".encode("latin-1"))
    put(f"{root}/e.csv", "")
    heads = {r.file_path.rsplit("/", 1)[1]: r for r in file_heads(spark, root).collect()}
    assert (heads["a.csv"].sep, heads["a.csv"].names, heads["a.csv"].bytes_read, heads["a.csv"].body) == (";", ["ano", "uf"], 2048, 10)
    assert (heads["b.csv"].sep, heads["b.csv"].names) == (",", ["year", "state"])
    assert heads["c.csv"].names[0] == "a\nb" and len(heads["c.csv"].names) == 901 and heads["c.csv"].bytes_read <= 32768
    latin = {r.file_path.rsplit("/", 1)[1]: r for r in file_heads(spark, root, encoding="ISO-8859-1").collect()}
    assert latin["d.csv"].names == ["único", "ano"] and "e.csv" not in latin
    with pytest.raises(ValueError):
        file_heads(spark, root, encoding="UTF-16")


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    text = re.sub(r"#\d+L?", "#", buf.getvalue())
    return re.sub(r"(file:)?/\S+", "PATH", re.sub(r"repartition\w*|RepartitionByExpression \[[^\]]*\], \d+|hashpartitioning\([^)]*\)", "DEALT", text))


def test_plan_does_not_grow_with_the_layouts(spark, scratch):
    plans = []
    for n in (2, 20):
        root = scratch(f"layouts-{n}")
        for i in range(n):
            put(f"{root}/{i}.csv", f"ano;extra{i};faixa;quantidade\n2020;x;A;{i}\n")
        good, bad = read_landing(spark, root, harmonise_tax)
        assert good.count() == n and bad.count() == 0
        plans.append(_plan(good))
    assert len(plans[0].splitlines()) == len(plans[1].splitlines()) and plans[0].count("MapInArrow") == plans[1].count("MapInArrow")


def test_torn_records_of_a_landing_folder_are_rejected(spark, scratch):
    root = scratch("torn")
    put(f"{root}/a.csv", 'ano;faixa;quantidade\n2020;"A;\nB";1.000\n2021;C\n2022;D;1;2\n;E;5\n20xx;F;6\n')
    good, bad = read_landing(spark, root, harmonise_tax)
    assert [(r.year, r.income_bracket, r.num_declarations) for r in good.collect()] == [(2020, "A;\nB", 1000)]
    assert sorted((r._reject_reason, r._raw_record) for r in bad.collect()) == [
        ("bad_year", '{"ano":"20xx","faixa":"F","quantidade":"6"}'), ("malformed", "2021;C"), ("malformed", "2022;D;1;2")]


def test_missing_columns_and_equal_names(spark, scratch):
    root = scratch("columns")
    put(f"{root}/a.csv", "x,y,x\n1,2,3\n")
    assert [tuple(r)[:3] for r in read_columns(spark, root, ["x", "y", "z"]).collect()] == [("1", "2", None)]
    with pytest.raises(ValueError, match="has no column z"):
        read_columns(spark, root, ["x", "z"], required=["x", "z"])


def test_written_csv_comes_back(spark, scratch):
    root = scratch("written")
    rows = [("a", 'He said "hi", ok', "10"), ("b", "two\nlines", "11"), ("c", None, None), ("d", 'ends with "', "é")]
    write_csv(spark.createDataFrame(rows, "k string, t string, v string"), root)
    assert sorted((r.k, r.t, r.v) for r in read_columns(spark, root, ["k", "t", "v"], range_bytes=17).collect()) == sorted(rows)


class Recorder:
    """A file in memory that notes how much is asked of it at a time."""

    def __init__(self, data):
        self.data, self.sizes = data, []

    def read_at(self, n, at):
        self.sizes.append(n)
        return self.data[at : at + n]


def records_of(src, length, step, names):
    """The rows of a file read range by range, each range's start state from the ranges before."""
    inside, rows = False, []
    for no, lo in enumerate(range(0, length, step)):
        row = {"path": "f", "file_path": "f", "length": length, "sep": ",", "names": names, "no": no, "lo": lo, "hi": min(lo + step, length), "inside": inside}
        for batch in ranges._records(src, row, names, "utf-8"):
            rows += [tuple(r.values())[:-1] for r in batch.to_pylist()]
        inside = ranges._end_states(src, row)[inside]
    return rows


def test_a_range_is_read_in_pieces(monkeypatch):
    monkeypatch.setattr(ranges, "PIECE_BYTES", 1 << 12)
    rows = [(str(i), f'line {i}\nand "more"' if i % 3 else f"plain {i}") for i in range(20_000)]
    data = "".join(f'{k},"{t}"\n'.replace('"more"', '""more""') if "\n" in t else f"{k},{t}\n" for k, t in rows).encode()
    src = Recorder(data)
    assert [r[:2] for r in records_of(src, len(data), len(data), ["k", "t"])] == rows
    assert max(src.sizes) < 20_000 < len(data) // 10


def test_pieces_and_ranges_give_the_records_of_the_whole(monkeypatch):
    monkeypatch.setattr(ranges, "PIECE_BYTES", 7)
    monkeypatch.setattr(ranges, "STEP_BYTES", 3)
    rnd = random.Random(3)
    key = lambda r: tuple(map(str, r))
    for _ in range(1500):
        text = "".join(rnd.choice(["a", "b", ",", ",", '"', '""', '"a\n",', "\n", "\r\n", ";", "é"]) for _ in range(rnd.randint(0, 25)))
        bounds, _ = machine(text, ",")
        want = []
        for record in (text[s:e].removesuffix("\n").removesuffix("\r") for s, e in bounds):
            if record:
                fields = fields_of(record, ",")
                want.append((fields[0], fields[1] if len(fields) > 1 else None, None if len(fields) == 2 else record))
        data = text.encode()
        for step in (5, 1000):
            assert sorted(records_of(Recorder(data), len(data), step, ["k", "t"]), key=key) == sorted(want, key=key), (text, step)


def test_quotes_around_fields_are_not_matched_one_by_one(monkeypatch):
    matched, patterns = [], ranges._patterns

    class Counted:
        def __init__(self, pattern):
            self.pattern = pattern

        def match(self, *args):
            matched.append(args)
            return self.pattern.match(*args)

    monkeypatch.setattr(ranges, "_patterns", lambda sep: tuple(map(Counted, patterns(sep))))
    data = b"".join(b'%d,"says ""x"", twice\nover two lines"\n' % i for i in range(1000))
    rows = records_of(Recorder(data), len(data), 8192, ["k", "t"])
    assert rows == [(str(i), 'says "x", twice\nover two lines', None) for i in range(1000)]
    assert len(matched) < 100  # a few at the ends of ranges


def test_small_ranges_share_tasks(spark, scratch):
    root = scratch("small-ranges")
    put(f"{root}/a.csv", "k,t\n" + "".join(f'{i},"line {i}\nend"\n' for i in range(4000)))
    df = read_columns(spark, root, ["k", "t"], range_bytes=64)
    assert df.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
    assert {(r.k, r.t) for r in df.collect()} == {(str(i), f"line {i}\nend") for i in range(4000)}
