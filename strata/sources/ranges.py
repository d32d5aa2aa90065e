"""Delimited text read in byte ranges, whatever each file's layout, quoted line breaks included.

A line break inside quotes is not the end of a record, so where a record starts in the middle of a
file depends on everything before.  Each range therefore answers two questions at once: if it starts
at a record, does it end inside quotes, and if it starts inside quotes, does it?  The answers of all
ranges compose by a scan over a small table (a row per range), which gives every range its true start.
A second pass then reads the records that start in each range; a task has a range, or several small
ones, and holds a piece of one at a time.
Files of one range skip the first pass.

Delimiter and column names are each file's own: the first bytes of every file are read by tasks over
the list of files, and travel with its ranges.  One plan reads any number of layouts.

Quoting follows the rules of Spark's CSV reader: a quote opens a field only at its start, two quotes
inside stand for one, and a field with text after its closing quote is taken as it stands.  Text
encodings must keep ASCII as it is (UTF-8, ISO-8859-*, windows-125*).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sources.stores import open_random

HEAD_BYTES = 2048
RANGE_BYTES = 64 << 20
RECORD_MAX = 512 << 20  # a longer record is an error: a quote that is never closed
PIECE_BYTES = 1 << 20  # of a range that a task holds at a time
TASK_BYTES = 16 << 20  # of small ranges that a task reads, one after the other
STEP_BYTES = 1 << 12  # first look for the end of a line or record
BATCH_ROWS = 1 << 14
BOM = b"\xef\xbb\xbf"
CANDIDATES = (";", ",")


# --- records in bytes ---------------------------------------------------------------------------


@cache
def _patterns(sep: str) -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """(a whole record from its start, what is left of one from inside quotes, one field of a record's text)."""
    s = re.escape(sep)
    quoted = r'[^"]*+(?:""[^"]*+)*+"'
    field = rf'(?:"{quoted}[^{s}\n]*+|[^"{s}\n][^{s}\n]*+|)'
    rest = rf"(?:{s}{field})*+(?:\n|\Z)"
    whole, inside = rf"{field}{rest}", rf"{quoted}[^{s}\n]*+{rest}"
    text = rf'(?:"((?:[^"]|"")*+)"(?={s}|\Z)|("(?:[^"]|"")*+"[^{s}]*+|[^{s}]*+))(?:{s}|\Z)'
    return re.compile(whole.encode()), re.compile(inside.encode()), re.compile(text, re.DOTALL)


def _turns(array: np.ndarray, quotes: np.ndarray, sep: str) -> np.ndarray:
    """For each quote, whether quotes open and close in turn if it is an opening one: each that then opens stands at the start of a field, or doubles the one before."""
    mark = sep.encode()
    out = np.ones(len(quotes) + 2, bool)
    before = array[np.maximum(quotes - 1, 0)]
    fine = ((quotes == 0) | (before == mark[0]) | (before == 10) | (before == 34)) & (len(mark) == 1)
    for first in (0, 1):
        out[first : len(quotes) : 2] = np.logical_and.accumulate(fine[first::2][::-1])[::-1]
    return out


def record_bounds(data: bytes, sep: str, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(starts, ends, quoted, open): the records that start in ``data``, which starts at a line.

    ``inside``: the line is the middle of a quoted field; the record around it is not among them.  ``open``:
    the data ends inside quotes; the record that is open then comes last, up to the end of the data.

    From where quotes open and close in turn, records are found at once; before, one by one.
    """
    whole, rest, _ = _patterns(sep)
    array = np.frombuffer(data, np.uint8)
    breaks, quotes = np.flatnonzero(array == 10), np.flatnonzero(array == 34)
    turns = _turns(array, quotes, sep)
    if turns[int(inside)]:
        return _paired_bounds(len(data), breaks, quotes, 0, inside)
    lines = np.concatenate([[0], breaks + 1])
    if lines[-1] == len(data):
        lines = lines[:-1]
    ends = np.append(lines[1:], len(data)) if len(lines) else lines
    marked = np.unique(np.searchsorted(lines, quotes, "right") - 1)  # lines that hold a quote
    found_bounds = []
    line, is_open = 0, False
    if inside:
        found = rest.match(data)
        if found is None:
            return lines[:0], lines[:0], np.zeros(0, bool), True
        line = int(np.searchsorted(lines, found.end()))
    for at in marked.tolist():
        if at < line:
            continue
        found_bounds.append((lines[line:at], ends[line:at], np.zeros(at - line, bool)))
        line, start = at, int(lines[at])
        if turns[np.searchsorted(quotes, start)]:
            *others, is_open = _paired_bounds(len(data), breaks, quotes, start, False)
            found_bounds.append(others)
            line = len(lines)
            break
        found = whole.match(data, start)
        stop = found.end() if found else len(data)
        found_bounds.append((lines[at : at + 1], np.array([stop]), np.ones(1, bool)))
        line, is_open = int(np.searchsorted(lines, stop)), found is None
        if is_open:
            break
    if not is_open:
        found_bounds.append((lines[line:], ends[line:], np.zeros(len(lines) - line, bool)))
    starts, stops, quoted = (np.concatenate(x) for x in zip(*found_bounds, strict=True))
    return starts, stops, quoted, is_open


def _paired_bounds(size: int, breaks: np.ndarray, quotes: np.ndarray, at: int, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """``record_bounds`` from a start of a line on, of quotes that open and close in turn: a record ends at a line end outside them."""
    breaks, quotes = breaks[np.searchsorted(breaks, at) :], quotes[np.searchsorted(quotes, at) :]
    outer = breaks[(np.searchsorted(quotes, breaks) + inside) % 2 == 0] + 1
    starts = outer if inside else np.concatenate([[at], outer])
    if len(starts) and starts[-1] == size:
        starts = starts[:-1]
    ends = np.append(starts[1:], size) if len(starts) else starts
    return starts, ends, np.searchsorted(quotes, ends) > np.searchsorted(quotes, starts), (len(quotes) + inside) % 2 == 1


def fields_of(record: str, sep: str) -> list[str | None]:
    """The fields of one record's text; an empty field is None, in quotes or not (as Spark's reader has it)."""
    if '"' not in record:
        return [f or None for f in record.split(sep)]
    out, at = [], 0
    pattern = _patterns(sep)[2]
    while True:
        found = pattern.match(record, at)
        if found is None:  # a quote that is never closed: the rest is one field
            return [*out, record[at:]]
        quoted, plain = found.groups()
        out.append((quoted.replace('""', '"') if quoted is not None else plain) or None)
        at = found.end()
        if at == len(record) and not record.endswith(sep, found.start(), found.end()):
            return out
        if at == len(record):
            return [*out, None]  # the record ends with a delimiter


def _decoded(data: bytes, encoding: str) -> str:
    return data.decode(encoding, "replace")


def _check_encoding(encoding: str) -> None:
    plain = bytes(range(128))
    if plain.decode(encoding, "replace") != plain.decode("ascii"):
        raise ValueError(f"{encoding} doesn't keep ASCII as it is; such files can't be read in ranges")


def _to_line(src, at: int, size: int) -> int:
    """The first start of a line at or after ``at`` (the end of the file if there is none)."""
    if at == 0:
        return 0
    at, n = at - 1, STEP_BYTES
    while at < size:
        piece = src.read_at(min(n, size - at), at)
        found = piece.find(b"\n")
        if found >= 0:
            return at + found + 1
        at, n = at + len(piece), min(4 * n, PIECE_BYTES)
    return size


# --- first bytes of files -----------------------------------------------------------------------


def list_files(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``path, length, file_path`` of every file; contents are not read.  ``file_path`` is what ``_metadata.file_path`` says."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("binaryFile").load(paths).select("path", "length", F.col("_metadata.file_path").alias("file_path"))


def file_heads(spark: SparkSession, path: str | Sequence[str] | DataFrame, candidates: Sequence[str] = CANDIDATES, encoding: str = "UTF-8", head_bytes: int = HEAD_BYTES) -> DataFrame:
    """``path, length, file_path, header, sep, names, body, bytes_read``: the first record of every file.

    ``path`` may be a frame of files as ``list_files`` gives it.  Tasks over the list of files read the first ``head_bytes`` of each, and more only while the first
    record goes on.  ``sep`` is the first candidate found in it, ``names`` its fields, ``body`` where the
    next record starts.  A byte-order mark is dropped.  Empty files are not listed.
    """
    _check_encoding(encoding)
    candidates = tuple(candidates)

    def run(batches):
        for batch in batches:
            out = []
            for name, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                with open_random(name) as src:
                    out.append(_head(src, length, candidates, encoding, head_bytes))
            kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "header", "sep", "names", "body", "bytes_read"])

    listed = path.select("path", "length", "file_path") if isinstance(path, DataFrame) else list_files(spark, path)
    tasks = spark.sparkContext.defaultParallelism
    kinds = "path string, length long, file_path string, header string, sep string, names array<string>, body long, bytes_read long"
    return listed.repartition(tasks, "path").mapInArrow(run, kinds)


def _head(src, length: int, candidates: tuple, encoding: str, head_bytes: int):
    n = head_bytes
    while True:
        data = src.read_at(min(n, length), 0)
        skip = len(BOM) if data.startswith(BOM) else 0
        line = data[skip:].split(b"\n", 1)[0].decode(encoding, "replace")
        sep = next((c for c in candidates if c in line), candidates[-1])
        body = data[skip:]
        starts, ends, _, is_open = record_bounds(body, sep, False)
        whole = len(ends) and not (is_open and len(ends) == 1) and body[: ends[0]].endswith(b"\n")
        if whole or n >= length:
            break
        n *= 4
    stop = int(ends[0]) if len(ends) else 0
    header = _decoded(body[:stop], encoding).rstrip("\r\n")
    return header, sep, [f or "" for f in fields_of(header, sep)], skip + stop, len(data)


# --- the two passes -----------------------------------------------------------------------------


def _ranges(heads: DataFrame, range_bytes: int) -> DataFrame:
    """A row per range of a file's records: ``no, lo, hi``."""
    body = heads.where("length > body")
    starts = body.withColumn("lo", F.explode(F.sequence("body", F.col("length") - 1, F.lit(int(range_bytes)).cast("long"))))
    return starts.withColumn("hi", F.least(F.col("lo") + int(range_bytes), "length")).withColumn("no", ((F.col("lo") - F.col("body")) / int(range_bytes)).cast("long"))


def _region(src, row) -> tuple[int, int]:
    """Start and end of a range, moved on to starts of lines."""
    lo = row["lo"] if row["no"] == 0 else _to_line(src, row["lo"], row["length"])
    return lo, max(lo, _to_line(src, row["hi"], row["length"]))


def _piece(src, at: int, hi: int, size: int) -> bytes:
    """What of a range is read next: lines of about ``PIECE_BYTES``, so that memory doesn't depend on the range's size."""
    return src.read_at(min(hi, _to_line(src, at + PIECE_BYTES, size)) - at, at)


def _end_states(src, row: dict) -> tuple[bool, bool]:
    """Whether a range ends inside quotes, if it starts outside and if it starts inside; without quotes it ends as it starts."""
    states = [False, True]
    at, hi = _region(src, row)
    while at < hi:
        data = _piece(src, at, hi, row["length"])
        if b'"' in data:
            known = {state: bool(record_bounds(data, row["sep"], state)[3]) for state in set(states)}
            states = [known[state] for state in states]
        at += len(data)
    return states[0], states[1]


def _states(ranges: DataFrame, tasks: int) -> DataFrame:
    """``path, no, inside``: whether a range starts inside quotes."""

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                with open_random(row["path"]) as src:
                    out.append((row["path"], row["no"], *_end_states(src, row)))
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 4, kinds, strict=True)], ["path", "no", "from_out", "from_in"])

    narrow = ranges.select("path", "length", "sep", "no", "lo", "hi").repartition(tasks, "path", "no")
    ends = narrow.mapInArrow(run, "path string, no long, from_out boolean, from_in boolean")
    # Composition: the last range whose end doesn't depend on its start fixes the state, each later one that swaps turns it.
    upto = Window.partitionBy("path").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    swaps = ((F.col("from_out") & ~F.col("from_in")).cast("int"))
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").alias("end"), F.col("turned").alias("turned")))
    counted = ends.withColumn("turned", F.sum(swaps).over(Window.partitionBy("path").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(fixed, ignorenulls=True).over(upto)
    before = F.coalesce(F.max("turned").over(upto), F.lit(0))
    turned = (before - F.coalesce(F.col("last.turned"), F.lit(0))) % 2 == 1
    return counted.withColumn("last", last).select("path", "no", (F.coalesce(F.col("last.end"), F.lit(False)) != turned).alias("inside"))


def _open_record(src, at: int, size: int, sep: str) -> bytes:
    """A record that starts at ``at``, as far as it goes."""
    n = STEP_BYTES
    while True:
        data = src.read_at(min(n, size - at), at)
        found = _patterns(sep)[0].match(data)
        if found and data[: found.end()].endswith(b"\n"):
            return data[: found.end()]
        if at + n >= size:
            return data
        if n >= RECORD_MAX:
            raise ValueError(f"a record of over {RECORD_MAX} bytes at {at}: a quote that is never closed?")
        n *= 4


def read_columns(spark: SparkSession, path: str | Sequence[str] | DataFrame, columns: Sequence[str], candidates: Sequence[str] = CANDIDATES, encoding: str = "UTF-8",
                 range_bytes: int = RANGE_BYTES, corrupt_column: str = "_corrupt_record", required: Sequence[str] = (),
                 as_map: bool = False) -> DataFrame:
    """The named columns of every file under ``path`` as text, with ``corrupt_column`` and ``_source_file``.

    Each file has a header and a delimiter of its own; a column that a file lacks is null there (if it
    is ``required``, that is an error; of equal names the first counts).  Fields in quotes may hold
    delimiters, doubled quotes and line breaks, and files are read in ranges all the same.  A record
    with too few or too many fields keeps its text in ``corrupt_column`` and the fields it has.  Empty
    lines are no records.  ``as_map`` gives one column ``_fields`` (name -> text) instead of a column each,
    for names that only differ in case.
    """
    columns = list(columns)
    head_path = scratch_path(spark, "file-heads")  # read for the counts and the ranges
    file_heads(spark, path, candidates, encoding).write.parquet(head_path)
    heads = spark.read.parquet(head_path)
    lacking = [F.when(~F.array_contains("names", c), F.lit(c)) for c in required]
    if lacking:
        bad = heads.withColumn("lacks", F.array_compact(F.array(*lacking))).where(F.size("lacks") > 0).select("file_path", "lacks").first()
        if bad is not None:
            raise ValueError(f"{bad.file_path} has no column {', '.join(bad.lacks)}")
    ranges = _ranges(heads, range_bytes)
    files = heads.where("length > body").count()
    size = ranges.agg(F.count(F.lit(1)).alias("parts"), F.coalesce(F.sum(F.col("hi") - F.col("lo")), F.lit(0)).alias("bytes")).first()
    # A task reads a range, or several small ones: as many tasks as the bytes ask for, and enough for all cores.
    tasks = max(1, min(size.parts, max(8 * spark.sparkContext.defaultParallelism, -(-size.bytes // TASK_BYTES)), 20_000))
    if size.parts > files:
        state_path = scratch_path(spark, "range-states")  # the first pass runs once, however often the rows are read
        _states(ranges, tasks).write.parquet(state_path)
        ranges = ranges.join(spark.read.parquet(state_path), ["path", "no"])
    else:
        ranges = ranges.withColumn("inside", F.lit(False))
    kinds = ", ".join(f"c{i} string" for i in range(len(columns)))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_random(row["path"]) as src:
                    yield from _records(src, row, columns, encoding)

    spread = ranges.select("path", "length", "file_path", "sep", "names", "no", "lo", "hi", "inside").repartition(tasks, "path", "no")
    rows = spread.mapInArrow(read, f"{kinds}, corrupt string, file string")
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]
    if as_map:
        named = [F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.col(f"c{i}"))]).alias("_fields")]
    return rows.select(*named, F.col("corrupt").alias(corrupt_column), F.col("file").alias("_source_file"))


def _records(src, row: dict, columns: list[str], encoding: str):
    """Record batches of the records that start in a range."""
    sep, names = row["sep"], row["names"]
    places = [names.index(c) if c in names else None for c in columns]
    at, hi = _region(src, row)
    inside = row["inside"]
    while at < hi:
        data = _piece(src, at, hi, row["length"])
        starts, ends, quoted, is_open = record_bounds(data, sep, inside)
        after, inside, tail = at + len(data), is_open, None
        if is_open and len(starts):
            start, inside = at + int(starts[-1]), False
            if after < hi and start > at:  # the next piece starts with it
                after = start
            else:
                tail = _open_record(src, start, row["length"], sep)
                after = start + len(tail)
            starts, ends, quoted = starts[:-1], ends[:-1], quoted[:-1]
        at = after
        yield from _split_records(data, starts, ends, quoted, sep, len(names), places, row["file_path"], encoding)
        if tail is not None:
            yield from _split([_decoded(tail, encoding)], sep, len(names), places, row["file_path"], plain=False)


def _split_records(data: bytes, starts: np.ndarray, ends: np.ndarray, quoted: np.ndarray, sep: str, width: int, places: list[int | None], file: str, encoding: str):
    """Record batches of records that follow one another."""
    if not len(starts):
        return
    text = data[starts[0] : ends[-1]]
    if _simple(text, sep):
        yield from _parsed(_decoded(text, encoding).encode(), sep, width, places, file)
        return
    # Runs of records without quotes are split at once, by Arrow; the others one by one.
    turns = np.flatnonzero(np.diff(quoted)) + 1
    for a, b in zip(np.concatenate([[0], turns]), np.append(turns, len(starts)), strict=True):
        for at in range(int(a), int(b), BATCH_ROWS):
            to = min(at + BATCH_ROWS, int(b))
            if quoted[at]:
                texts = [_decoded(data[s:e], encoding) for s, e in zip(starts[at:to].tolist(), ends[at:to].tolist(), strict=True)]
                yield from _split(texts, sep, width, places, file, plain=False)
            else:
                texts = _decoded(data[starts[at] : ends[to - 1]], encoding).split("\n")
                yield from _split(texts, sep, width, places, file, plain=True)


def _simple(text: bytes, sep: str) -> bool:
    """Whether whole records are such that Arrow's CSV reader sees the fields that ``fields_of`` sees: quotes around whole fields only, no carriage returns."""
    if b"\r" in text or text.startswith(BOM) or len(text) > 1 << 30:
        return False
    array = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(array == 34)
    if not _turns(array, quotes, sep)[0] or len(sep.encode()) != 1:
        return False
    closing = quotes[1::2]
    after = array[closing[closing < len(array) - 1] + 1]
    return bool(np.all((after == sep.encode()[0]) | (after == 10) | (after == 34)))


def _parsed(text: bytes, sep: str, width: int, places: list[int | None], file: str):
    """Record batches of ``_simple`` records; those with too few or too many fields are split one by one."""
    ragged = []

    def keep(row) -> str:
        ragged.append(row.text)
        return "skip"

    names = [f"f{i}" for i in range(width)]
    table = pacsv.read_csv(
        pa.BufferReader(text),
        pacsv.ReadOptions(use_threads=False, block_size=len(text) + 1, column_names=names),
        pacsv.ParseOptions(delimiter=sep, newlines_in_values=True, invalid_row_handler=keep),
        pacsv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), include_columns=sorted({f"f{p}" for p in places if p is not None}) or names[:1],
                             null_values=[""], strings_can_be_null=True, check_utf8=False),
    )
    for batch in table.to_batches(max_chunksize=BATCH_ROWS):
        n = batch.num_rows
        yield _batch([batch.column(f"f{p}") if p is not None else pa.nulls(n, pa.string()) for p in places], pa.nulls(n, pa.string()), file)
    yield from _split(ragged, sep, width, places, file, plain=False)


def _ended(text: str) -> str:
    """A record's text without its line end."""
    text = text[:-1] if text.endswith("\n") else text
    return text[:-1] if text.endswith("\r") else text


def _split(texts: list[str], sep: str, width: int, places: list[int | None], file: str, plain: bool):
    texts = [t for t in map(_ended, texts) if t]
    if not texts:
        return
    if plain:
        lists = pc.split_pattern(pa.array(texts, pa.string()), sep)
        counts = pc.list_value_length(lists).to_numpy()
        fine = counts == width
        values = lists.filter(pa.array(fine)).flatten()
        values = pc.if_else(pc.equal(values, ""), pa.scalar(None, pa.string()), values)
        good = len(values) // width
        steps = np.arange(good) * width
        found = [values.take(pa.array(steps + p)) if p is not None else pa.nulls(good, pa.string()) for p in places]
        if good:
            yield _batch(found, pa.nulls(good, pa.string()), file)
        texts = [t for t, f in zip(texts, fine.tolist(), strict=True) if not f]
        if not texts:
            return
    rows = [fields_of(t, sep) for t in texts]
    corrupt = [None if len(r) == width else t for r, t in zip(rows, texts, strict=True)]
    found = [pa.array([r[p] if p is not None and p < len(r) else None for r in rows], pa.string()) for p in places]
    yield _batch(found, pa.array(corrupt, pa.string()), file)


def _batch(found: list, corrupt, file: str) -> pa.RecordBatch:
    names = [f"c{i}" for i in range(len(found))]
    return pa.RecordBatch.from_arrays([*found, corrupt, pa.repeat(pa.scalar(file, pa.string()), len(corrupt))], [*names, "corrupt", "file"])
