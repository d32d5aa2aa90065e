"""Token-id files: one compressed frame per document, a shared dictionary, an offset index.

A document's ids are serialized as little-endian integers (16 bits where the vocabulary
allows, else 32) and compressed on their own, so any document can be read without its
neighbours.  Short arrays compress badly alone; all frames therefore share one zstandard
dictionary, trained on the serialized arrays of a bounded sample of short documents.  The
sample only shapes the dictionary: every document is encoded and written whole.

A file is a header (magic, integer width, SHA-256 of the dictionary), the frames, and a
footer with the offset and number of ids of every frame.  The dictionary lies beside the
files under its hash and is checked against it when read.  The index table that Spark commits
names the document, file, offset and length of every frame, and how many ids come before it.

Tasks write files under names that no other attempt uses; what a lost or repeated attempt
leaves behind is in no index and is never read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.warc import _open
from strata.session import scratch_path

MAGIC = b"IDZ1"
NO_DICTIONARY = bytes(32)
HEAD = len(MAGIC) + 4 + 32
FOOT = np.dtype([("offset", "<u8"), ("n_tokens", "<u8")])
SAMPLE_DOCS = 1024  # most documents that the dictionary is trained on
SAMPLE_CHARS = 8192  # longer documents are not trained on: they carry enough context of their own
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
FILE_BYTES = 64 << 20  # a task starts another file beyond this
BLOCK_BYTES = 32 << 20  # frames read by one task, about
BATCH_BYTES = 4 << 20
SLICE_BYTES = 1 << 20  # text worked out at once
WORDS_HELD = 3 << 18  # words whose ids a task remembers


# --- ids of texts -----------------------------------------------------------------------------------


# A file with this pattern, whose other characters are dropped, makes white space a boundary that nothing crosses, and a
# text's ids those of the pattern's matches in turn.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed by the vocabulary
# Texts of ASCII and of the letters from U+00C0 to U+00FF are worked out here: no normal form changes those characters, and
# the class of each is plain.  Texts with any other go through the tokenizer as they are.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = _LETTER  # of lower-cased bytes
_CLASS[0x30:0x3A] = _DIGIT
_BLANK = re.compile("[ \\t-\\r]")
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x20, 0x7F), *range(0x09, 0x0E)]] = True


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_LETTERS = _byte_letters()


def _after(data: np.ndarray, byte: int) -> np.ndarray:
    """Where the byte before is ``byte``."""
    out = np.zeros(len(data), bool)
    out[1:] = data[:-1] == byte
    return out


def _lower(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased bytes, whether a byte belongs to a character that is worked out here)."""
    second = _after(data, 0xC3)
    plain = _PLAIN[data] | (data == 0xC3) | (second & (data != 0x97) & (data != 0xB7))
    plain[1:] &= ~((data[1:] == 0x7C) & (data[:-1] == 0x3C))  # "<|" may open a special token
    low = textops.LOWER[data]
    low[second & (data >= 0x80) & (data <= 0x9E)] += 0x20
    return low, plain


def _matches(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the pattern's matches in lower-cased texts."""
    kind = _CLASS[low]
    new = np.ones(len(low), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    new[offsets[:-1][offsets[:-1] < len(low)]] = True
    edges = np.append(np.flatnonzero(new), len(low))
    starts, ends = edges[:-1], edges[1:].copy()
    # A lone apostrophe takes a short ending from the letters after it.
    mark = np.flatnonzero((low[starts] == 0x27) & (ends - starts == 1)) if len(starts) else starts
    mark = mark[mark + 1 < len(starts)]
    mark = mark[(kind[starts[mark + 1]] == _LETTER) & ~np.isin(starts[mark + 1], offsets)]
    at = starts[mark + 1]
    first, second = low[at], np.where(at + 1 < ends[mark + 1], low[np.minimum(at + 1, len(low) - 1)], 0)
    taken = np.where(np.isin(first, list(b"stmd")), 1, 0)
    taken[((first == 0x72) & (second == 0x65)) | ((first == 0x76) & (second == 0x65)) | ((first == 0x6C) & (second == 0x6C))] = 2
    starts = starts.copy()
    ends[mark] += taken
    starts[mark + 1] += taken
    keep = (kind[np.minimum(starts, len(low) - 1)] != _SPACE) & (ends > starts) if len(starts) else np.zeros(0, bool)
    return starts[keep], ends[keep]


class Words:
    """Ids of the matches met so far, by their 64-bit hash; sorted arrays, so a million take some tens of MB."""

    def __init__(self, model):
        self.merge = model.model.tokenize
        self.forget()

    def forget(self) -> None:
        self.hashes, self.at, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = [[t.id for t in self.merge(w.decode() if w.isascii() else "".join(_LETTERS[b] for b in w))] for w in words]
        n = np.array([len(f) for f in found], np.int64)
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, np.array([i for f in found for i in f], np.uint32)])
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.at, self.n = (np.insert(x, place, y) for x, y in ((self.hashes, hashes), (self.at, at), (self.n, n)))

    def read(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all matches in turn, how many each has)."""
        unique, first, inverse = np.unique(textops.span_hashes(low, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(unique) > WORDS_HELD:
            self.forget()
        place = np.searchsorted(self.hashes, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == unique[inside]
        if not known.all():
            raw, new = low.tobytes(), np.flatnonzero(~known)
            self._learn(unique[new], [raw[s:e] for s, e in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            place = np.searchsorted(self.hashes, unique)
        at, n = self.at[place][inverse], self.n[place][inverse]
        before = np.cumsum(n) - n
        return self.ids[np.arange(n.sum()) + np.repeat(at - before, n)], n


_models: dict[str, tuple] = {}


def _model(path: str):
    """(tokenizer, its ids by match or None where the file has another pattern, size of the vocabulary) of a tokenizers file."""
    if path not in _models:
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        known = split.get("pattern") == {"Regex": PATTERN} and split.get("behavior") == "Removed" and split.get("invert") is True
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        words = Words(model) if known and steps == ["NFC", "Replace", "Lowercase"] else None
        _models[path] = model, words, model.get_vocab_size(with_added_tokens=True)
    return _models[path]


def text_ids(path: str, texts: pa.Array, end_id: int):
    """Ids of every text and the end id, as unsigned 32-bit integers; a null text is empty."""
    end = np.array([end_id], np.uint32)
    for ids in _plain_ids(path, texts):
        yield np.concatenate([ids, end])


def _cut(text: str):
    """A long text in parts of about ``SLICE_BYTES`` characters, cut before white space."""
    at = 0
    while at < len(text):
        found = _BLANK.search(text, min(at + SLICE_BYTES, len(text)))
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


def _plain_ids(path: str, texts: pa.Array):
    model, words, _ = _model(path)

    def whole(text: str | None) -> np.ndarray:
        return np.array(model.encode(text or "", add_special_tokens=False).ids, np.uint32)

    if words is None:
        for text in texts:
            yield whole(text.as_py())
        return
    for lo, hi in textops.slices(texts, SLICE_BYTES):
        part = texts.slice(lo, hi - lo)
        if hi - lo == 1 and len(text := part[0].as_py() or "") > 2 * SLICE_BYTES and _BLANK.search(text, SLICE_BYTES):
            yield np.concatenate([ids for piece in _cut(text) for ids in _plain_ids(path, pa.array([piece]))])
            continue
        data, offsets = textops.text_bytes(part)
        low, plain = _lower(data)
        odd = np.diff(np.concatenate([[0], np.cumsum(~plain)])[offsets]) > 0
        starts, ends = _matches(low, offsets)
        own = np.searchsorted(offsets, starts, "right") - 1
        some = ~odd[own]
        ids, n = words.read(low, starts[some], ends[some])
        stops = np.cumsum(np.bincount(own[some], n, hi - lo).astype(np.int64))
        for i, (stop, other) in enumerate(zip(stops.tolist(), odd.tolist(), strict=True)):
            yield whole(texts[lo + i].as_py()) if other else ids[stops[i - 1] if i else 0 : stop]


# --- dictionary -------------------------------------------------------------------------------------


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary of serialized arrays, or nothing where there are too few to learn from."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) > 7 else b""
    except zstandard.ZstdError:  # too little to learn from
        return b""


def _sample(docs: DataFrame, most: int, most_chars: int) -> list[str]:
    """Texts of at most ``most`` short documents, chosen by a hash of id and text."""
    total = docs.select(F.lit(1)).count()  # from the files' footers
    if not most or not total:
        return []
    share = min(1.0, 2 * most / total)
    chosen = docs.where(F.length("text").between(1, most_chars)).where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    return [r["text"] for r in chosen.select("text").limit(most).collect()]


def _write_dictionary(uri: str, blob: bytes) -> bytes:
    """Put a dictionary beside the files that use it; returns its hash."""
    digest = hashlib.sha256(blob).digest() if blob else NO_DICTIONARY
    if blob:
        with _open(_dictionary_uri(uri, digest), "w") as out:
            out.write(blob)
    return digest


def _dictionary_uri(uri: str, digest: bytes) -> str:
    return f"{uri}/dictionary-{digest.hex()}.zdict"


def load_dictionary(uri: str, digest: bytes) -> bytes:
    """The dictionary of a hash, checked against it."""
    if digest == NO_DICTIONARY:
        return b""
    with _open(_dictionary_uri(uri, digest), "r") as src:
        blob = src.read()
    if hashlib.sha256(blob).digest() != digest:
        raise ValueError(f"the dictionary beside {uri} is not the one its files were written with")
    return blob


def _codec(blob: bytes, kind: str):
    import zstandard

    shared = zstandard.ZstdCompressionDict(blob) if blob else None
    if kind == "write":
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)
    return zstandard.ZstdDecompressor(dict_data=shared)


# --- writing ----------------------------------------------------------------------------------------


class _File:
    """One token file in the making."""

    def __init__(self, uri: str, width: int, digest: bytes):
        self.uri = f"{uri}/ids-{uuid.uuid4().hex}.idz"
        self.out = _open(self.uri, "w")
        self.out.write(MAGIC + width.to_bytes(4, "little") + digest)
        self.at, self.frames = HEAD, []

    def add(self, frame: bytes, n_tokens: int) -> int:
        self.out.write(frame)
        self.frames.append((self.at, n_tokens))
        self.at += len(frame)
        return self.frames[-1][0]

    def close(self) -> None:
        self.out.write(np.array(self.frames, FOOT).tobytes() + len(self.frames).to_bytes(8, "little") + MAGIC)
        self.out.close()


def write_token_files(docs: DataFrame, tokenizer: str, uri: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, sample: int = SAMPLE_DOCS,
                      file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all documents in ascending id order; returns the index ``id, file, offset, n_bytes, n_tokens, start``.

    ``start`` counts the ids of all documents before.  Null ids come last; rows that repeat an id are
    ordered by a hash of their text (equal rows are interchangeable).  Null and empty texts have the
    end id only.  An empty table has an empty index; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    *_, vocabulary = _model(tokenizer)
    width = 2 if max(vocabulary - 1, end_id) < 1 << 16 else 4
    arrays = [ids.astype(f"<u{width}").tobytes() for ids in text_ids(tokenizer, pa.array(_sample(docs, sample, SAMPLE_CHARS), pa.string()), end_id)]
    digest = _write_dictionary(uri, train_dictionary(arrays))

    def write(batches):
        codec, file, start = None, None, 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            codec = codec or _codec(load_dictionary(uri, digest), "write")
            rows = []
            for ids in text_ids(tokenizer, batch.column("text"), end_id):
                n = len(ids)
                frame = codec.compress(ids.astype(f"<u{width}").tobytes())
                file = file or _File(uri, width, digest)
                rows.append((part, file.uri, file.add(frame, n), len(frame), n, start))
                start += n
                if file.at >= file_bytes:
                    file.close()
                    file = None
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.string(), *[pa.int64()] * 4), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "part", "file", "offset", "n_bytes", "n_tokens", "start"])
        if file is not None:
            file.close()

    key = [F.col("id").isNull(), F.col("id"), F.xxhash64("text"), F.col("no")]  # the last one spreads rows that are all the same
    ordered = docs.withColumn("no", F.monotonically_increasing_id()).repartitionByRange(*key).sortWithinPartitions(*key).select("id", "text")
    kind = docs.schema["id"].dataType.simpleString()
    path = scratch_path(spark, "token-index")
    ordered.mapInArrow(write, f"id {kind}, part int, file string, offset long, n_bytes long, n_tokens long, start long").write.parquet(path)
    index = spark.read.parquet(path)

    before, at = [], 0
    for part, n in index.groupBy("part").agg(F.sum("n_tokens")).orderBy("part").collect():  # a row per writing task
        before.append((part, at))
        at += n
    starts = spark.createDataFrame(before, "part int, before long")
    return index.join(starts, "part").select("id", "file", "offset", "n_bytes", "n_tokens", (F.col("before") + F.col("start")).alias("start"))


# --- reading ----------------------------------------------------------------------------------------


def _head(src) -> tuple[int, bytes]:
    head = src.read_at(HEAD, 0)
    if head[:4] != MAGIC:
        raise ValueError("not a token file")
    return int.from_bytes(head[4:8], "little"), head[8:]


def footer(uri: str) -> np.ndarray:
    """Offset and number of ids of every frame of a file, from the file alone."""
    with _open(uri, "r") as src:
        size = src.size()
        tail = src.read_at(12, size - 12)
        if tail[8:] != MAGIC:
            raise ValueError("the token file is cut off")
        n = int.from_bytes(tail[:8], "little") * FOOT.itemsize
        return np.frombuffer(src.read_at(n, size - 12 - n), FOOT)


def read_token_files(index: DataFrame, keys: Column | None = None) -> DataFrame:
    """``id, start, n_tokens, ids`` (little-endian unsigned 32-bit) of the documents of an index.

    With ``keys``, a condition on the index, only the frames of those documents are read.
    """
    spark = index.sparkSession
    index = index if keys is None else index.where(keys)
    total = index.agg(F.sum("n_bytes")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // BLOCK_BYTES))
    placed = index.withColumn("block", F.floor(F.col("offset") / F.lit(BLOCK_BYTES)))
    placed = placed.repartition(int(tasks), "file", "block").sortWithinPartitions("file", "offset")

    def read(batches):
        file, src, codec, width, codecs = None, None, None, 0, {}
        try:
            for batch in batches:
                rows, ids, size = [], [], 0

                def out(batch=batch):
                    at = pa.array(rows, pa.int64())
                    taken = [batch.column(c).take(at) for c in ("id", "start", "n_tokens")]
                    return pa.RecordBatch.from_arrays([*taken, pa.array(ids, pa.binary())], ["id", "start", "n_tokens", "ids"])

                places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "n_bytes", "n_tokens")), strict=True)
                for row, (uri, offset, n_bytes, n_tokens) in enumerate(places):
                    if uri != file:
                        if src is not None:
                            src.close()
                        file, src = uri, _open(uri, "r")
                        width, digest = _head(src)
                        if digest not in codecs:
                            codecs[digest] = _codec(load_dictionary(uri.rsplit("/", 1)[0], digest), "read")
                        codec = codecs[digest]
                    array = np.frombuffer(codec.decompress(src.read_at(n_bytes, offset)), f"<u{width}").astype("<u4")
                    if len(array) != n_tokens:
                        raise ValueError(f"{uri} holds {len(array)} ids at {offset}, its index says {n_tokens}")
                    rows.append(row)
                    ids.append(array.tobytes())
                    size += len(ids[-1])
                    if size >= BATCH_BYTES:
                        yield out()
                        rows, ids, size = [], [], 0
                if rows:
                    yield out()
        finally:
            if src is not None:
                src.close()

    kind = index.schema["id"].dataType.simpleString()
    return placed.mapInArrow(read, f"id {kind}, start long, n_tokens long, ids binary")
