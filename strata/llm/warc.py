"""WARC archives: write, normalise monolithic gzip files, read back by index.

Pages become response records; a page whose payload another page holds too
becomes a revisit record that names it.  The writer compresses a file as one gzip
stream, as many crawlers' files are.  The normaliser inflates such a file once,
as a stream, rewrites every record as a gzip member of its own, and writes a
sidecar index of offsets; records can then be read one by one.

Files are written by tasks under names that no other attempt uses, and listed in
a table that Spark commits with the stage.  What a lost or repeated attempt leaves
behind is in no list and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the WARC format
GZIP = 31  # zlib's window bits for a gzip wrapper
FILE_BYTES = 64 << 20
READ_BYTES = 1 << 20


def _open(uri: str, mode: str):
    """A file of the shared store by its URI, for reading or writing."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if mode == "r":
        return store.open_input_file(path)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)


def _record(kind: str, record_id: str, url: str | None, date: str, payload: bytes, n: int, sha1: bytes, refers_to: str | None) -> bytes:
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % n + payload
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {name.strip().lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def inflate(stream, chunk: int = READ_BYTES):
    """Bytes of a gzip stream of one or many members, piece by piece."""
    zipped, left = None, b""
    while data := left or stream.read(chunk):
        zipped = zipped or zlib.decompressobj(GZIP)
        yield zipped.decompress(data, chunk * 4)
        left = zipped.unconsumed_tail
        if zipped.eof:
            zipped, left = None, zipped.unused_data
    if zipped is not None:
        yield zipped.flush()
        if not zipped.eof:
            raise ValueError("the gzip stream is cut off")


def records(pieces):
    """Whole records (header, blank line, block, two line ends) from inflated pieces; one record is held at a time."""
    buffer, pieces = bytearray(), iter(pieces)

    def fill(until) -> int:
        nonlocal buffer
        while (at := until()) < 0:
            piece = next(pieces, None)
            if piece is None:
                return -1
            buffer += piece
        return at

    searched = 0

    def head_end() -> int:
        nonlocal searched
        at = buffer.find(b"\r\n\r\n", max(0, searched - 3))
        searched = len(buffer)
        return at

    while True:
        searched = 0
        end = fill(head_end)
        if end < 0:
            if buffer.strip(b"\r\n"):
                raise ValueError("the last record is cut off")
            return
        head = parse_head(bytes(buffer[:end]))
        size = end + 4 + int(head["content-length"]) + 4
        if fill(lambda size=size: size if len(buffer) >= size else -1) < 0:
            raise ValueError("the last record is cut off")
        yield head, bytes(buffer[:size])
        del buffer[:size]


def split_payload(record: bytes) -> tuple[dict[str, str], int, bytes]:
    """(WARC header, payload length named by the HTTP header, payload)."""
    head, _, block = record.partition(b"\r\n\r\n")
    http, _, payload = block[:-4].partition(b"\r\n\r\n")
    lengths = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return parse_head(head), int(lengths[0]), payload


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 1000) -> DataFrame:
    """``id, url, payload, refers_to``: the largest id among equal payloads of ``least`` bytes or more, null for itself.

    Payloads are equal when SHA-1, length and a further 64-bit hash agree.  Null html is an empty
    payload.  A null id loses against any other; rows that repeat id and payload are all responses.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    key = ["sha1", "n", "h"]
    rows = rows.withColumns({"sha1": F.sha1("payload"), "n": F.octet_length("payload"), "h": F.xxhash64("payload")})
    shared = rows.where(F.col("n") >= least).groupBy(*key).agg(F.count(F.lit(1)).alias("c"), F.max("id").alias("best")).where("c > 1 AND best IS NOT NULL").drop("c")
    joined = rows.join(shared, key, "left")
    return joined.select("id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("best")), F.col("best")).alias("refers_to"))


def _as_text(value) -> str:
    return "" if value is None else str(value)


def write_monolithic(rows: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write WARC files of one gzip stream each; the list of files as a table ``path, records``."""

    def run(batches):
        out = None
        for batch in batches:
            for lo in range(0, len(batch), 64):
                for row in batch.slice(lo, 64).to_pylist():
                    if out is None:
                        path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out, zipped = _open(path, "w"), zlib.compressobj(6, zlib.DEFLATED, GZIP)
                    payload = row["payload"]
                    sha1 = hashlib.sha1(payload).digest()
                    again = row["refers_to"] is not None
                    data = zipped.compress(_record(
                        "revisit" if again else "response", f"urn:page:{_as_text(row['id'])}", row["url"], date, b"" if again else payload, len(payload), sha1,
                        f"urn:page:{row['refers_to']}" if again else None))
                    out.write(data)
                    n, size = n + 1, size + len(data)
                    if size >= file_bytes:
                        out.write(zipped.flush())
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})
        if out is not None:
            out.write(zipped.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return rows.mapInArrow(run, "path string, records long")


_INDEX = "path string, offset long, length long, record_id string, record_type string, source string"


def normalise_file(source: str, target: str):
    """Rewrite one file with a gzip member per record and a sidecar ``.idx`` of JSON lines; the index rows."""
    index, offset = [], 0
    with _open(source, "r") as stream, _open(target, "w") as out:
        for head, record in records(inflate(stream)):
            zipped = zlib.compressobj(6, zlib.DEFLATED, GZIP)
            member = zipped.compress(record) + zipped.flush()
            out.write(member)
            index.append({"path": target, "offset": offset, "length": len(member), "record_id": head.get("warc-record-id"), "record_type": head.get("warc-type"), "source": source})
            offset += len(member)
    with _open(f"{target}.idx", "w") as out:
        for entry in index:
            out.write(json.dumps(entry).encode() + b"\n")
    return index


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Normalise every file in ``files.path`` (one or many gzip members, whole-file streams included); the offset index."""

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = normalise_file(path, f"{folder}/{uuid.uuid4().hex}.warc.gz")
                for lo in range(0, len(rows), 1000):
                    yield pa.RecordBatch.from_pylist(rows[lo : lo + 1000])

    # One task per file: the list is tiny, so left to itself Spark would merge all files into one task.
    return files.select("path").repartition(max(1, files.count())).mapInArrow(run, _INDEX)


def read_indexed(index: DataFrame) -> DataFrame:
    """Read records by the index: ``id, payload_bytes, payload_digest, record_type, refers_to, payload``.

    A response's payload is checked against its digest.  A revisit has no payload of its own: bytes
    and digest are those of the full payload, from its headers; the payload is null.
    """

    def run(batches):
        opened = stream = None
        for batch in batches:
            for lo in range(0, len(batch), 256):
                out = []
                for row in batch.slice(lo, 256).to_pylist():
                    if row["path"] != opened:
                        if stream is not None:
                            stream.close()
                        opened, stream = row["path"], _open(row["path"], "r")
                    stream.seek(row["offset"])
                    head, n, payload = split_payload(zlib.decompress(stream.read(row["length"]), GZIP))
                    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                    again = head["warc-type"] == "revisit"
                    if not again and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"{row['path']}: the record at {row['offset']} doesn't match its digest")
                    ids = [head.get(x, "").strip("<>").removeprefix("urn:page:") or None for x in ("warc-record-id", "warc-refers-to")]
                    out.append((ids[0], n, digest, head["warc-type"], ids[1], None if again else payload))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()), strict=True)],
                                                 ["id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])
        if stream is not None:
            stream.close()

    files = index.select("path").distinct().count()
    placed = index.select("path", "offset", "length").repartition(max(1, files), "path").sortWithinPartitions("path", "offset")
    return placed.mapInArrow(run, "id string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")


def archive(pages: DataFrame, folder: str, **columns) -> DataFrame:
    """Write ``pages`` as monolithic files under ``folder``, normalise them, and return the index table.

    An empty table gives an empty index.  Long pages are held one at a time per task; columns other
    than id, url and html are not read.
    """
    spark = pages.sparkSession
    write_monolithic(mark_revisits(pages, **columns), f"{folder}/monolithic").write.parquet(f"{folder}/files")
    normalise(spark.read.parquet(f"{folder}/files"), f"{folder}/records").write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def shared_uri(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint root, with its scheme."""
    path = scratch_path(spark, name)
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
