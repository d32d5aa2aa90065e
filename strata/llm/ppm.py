"""Language-model scores: prediction by partial matching (PPM) over bytes, and a unigram base score.

The model is a trie of byte contexts up to a given order (7 at most).  A symbol is predicted in the
longest context that was seen; if it wasn't seen there, the model escapes to the
next shorter context (escape estimate: the number of distinct symbols seen there),
and symbols that the longer context would have predicted are excluded from the
shorter one's counts.  ``code_lengths`` scores documents with a trie learned from
the training documents; ``AdaptivePPM`` starts empty and learns as it reads.

On Spark, texts are cut into chunks of a few megabytes.  A chunk counts its words
and its byte contexts, counts are merged per bucket (words: by hash; contexts: by
their last byte, so that a context and all its shorter ones meet), and each chunk
gets back the model's answers for just the words and contexts that it holds.
Nothing of the corpus passes through the driver but the 256 byte counts and three
totals; no model is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.session import scratch_path

ORDER = 3
ORDER_MAX = 7  # a 64-bit key holds seven context bytes and the symbol
EDGE = 0xFF  # stands before and after a text; the byte doesn't occur in UTF-8
CHUNK_BYTES = 8 << 20
FAN = 64  # chunks merged, or answered, in one task
WORD_BUCKET_BYTES = 32 << 20  # text per bucket of words
END = int(textops.mix64(np.array([0x00C0FFEE], np.uint64))[0])  # the end token's hash


# --- the model ----------------------------------------------------------------------------------


class AdaptivePPM:
    """PPM (escape method C, with exclusion) as a plain trie; learns with ``update``."""

    def __init__(self, order: int = ORDER):
        self.order, self.counts = order, {}

    def update(self, context: bytes, symbol: int) -> None:
        for n in range(self.order + 1):
            node = self.counts.setdefault(context[len(context) - n :], {})
            node[symbol] = node.get(symbol, 0) + 1

    def log10(self, context: bytes, symbol: int) -> float:
        excluded: dict[int, int] = {}
        total = 0.0
        for n in range(self.order, -1, -1):
            seen = self.counts.get(context[len(context) - n :], {})
            left = {s: c for s, c in seen.items() if s not in excluded}
            if left:
                room = sum(left.values()) + len(left)
                if symbol in left:
                    return total + math.log10(left[symbol] / room)
                total += math.log10(len(left) / room)
            excluded = seen or excluded
        return total - math.log10(256 - len(excluded))

    def read(self, text: bytes, learn: bool) -> float:
        """log10 probability of a text and its end, learning along if asked."""
        padded, total = bytes([EDGE]) * self.order + text + bytes([EDGE]), 0.0
        for i in range(self.order, len(padded)):
            context = padded[i - self.order : i]
            total += self.log10(context, padded[i])
            if learn:
                self.update(context, padded[i])
        return total


def model_answers(keys: np.ndarray, counts: np.ndarray, zero: np.ndarray, orders: Sequence[int] = (ORDER,)) -> np.ndarray:
    """log10 probability of every key (context bytes, then the symbol) of one last context byte: a row per order.

    Keys have as many context bytes as the largest order; a smaller one takes the last of them.  ``counts`` are training counts, 0 for keys that are only asked for; ``zero`` the 256 counts without context.
    """
    keys = keys.astype(np.int64)
    symbol = keys & 255
    seen = counts > 0
    levels = []  # longest first: (row of each key, per row: count, distinct, mass of its symbols one level below; n of each key)
    for n in range(max(orders), -1, -1):
        context = keys >> 8 & (1 << 8 * n) - 1
        rows, row = np.unique(context, return_inverse=True)
        if n == 0:
            table = zero
        else:
            pair, at = np.unique(row[seen] * 256 + symbol[seen], return_inverse=True)
            table = np.zeros(len(rows) * 256, np.int64) if len(rows) <= 1 << 12 else None
            sums = np.bincount(at, counts[seen], minlength=len(pair)).astype(np.int64)
            if table is not None:
                table[pair] = sums
            else:
                table = (pair, sums)
        levels.append((rows, row, table))

    def lookup(table, at):
        if isinstance(table, tuple):
            pair, sums = table
            if not len(pair):
                return np.zeros(len(at), np.int64)
            i = np.minimum(np.searchsorted(pair, at), len(pair) - 1)
            return np.where(pair[i] == at, sums[i], 0)
        return table[at]

    def entries(table):
        """(row * 256 + symbol, count) of what was seen at a level."""
        if isinstance(table, tuple):
            return table
        at = np.flatnonzero(table)
        return at, table[at]

    stats = []
    for i, (rows, row, table) in enumerate(levels):
        pair, n = entries(table)
        total, distinct = np.bincount(pair // 256, n, minlength=len(rows)), np.bincount(pair // 256, minlength=len(rows))
        below = np.zeros(len(rows))
        if i < len(levels) - 1:
            lower_rows, _, lower = levels[i + 1]
            shorter = np.searchsorted(lower_rows, rows & (1 << 8 * (len(levels) - 2 - i)) - 1)  # the row of each context's suffix
            below = np.bincount(pair // 256, lookup(lower, shorter[pair // 256] * 256 + pair % 256), minlength=len(rows))
        stats.append((total, distinct, below))

    rest = 256 - int((zero > 0).sum())

    def walk(order):
        out = np.zeros(len(keys))
        open_ = np.ones(len(keys), bool)
        gone_n, gone_d = np.zeros(len(keys)), np.zeros(len(keys), np.int64)  # excluded mass and symbols at the level at hand
        for (rows, row, table), (total, distinct, below) in list(zip(levels, stats, strict=True))[len(levels) - 1 - order :]:
            n = lookup(table, row * 256 + symbol)
            fresh = distinct[row] - gone_d
            room = total[row] - gone_n + fresh
            usable = open_ & (fresh > 0)
            hit = usable & (n > 0)
            out[hit] += np.log10(n[hit] / room[hit])
            miss = usable & (n == 0)
            out[miss] += np.log10(fresh[miss] / room[miss])
            open_ &= n == 0
            known = distinct[row] > 0
            gone_n = np.where(known, below[row], 0.0)
            gone_d = np.where(known, distinct[row], 0)
        out[open_] -= math.log10(rest) if rest else 0.0
        return out

    return np.stack([walk(order) for order in orders])


# --- chunks -------------------------------------------------------------------------------------


def context_keys(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(keys of every byte and every end: ``order`` context bytes and the symbol, keys before each text)."""
    n = np.diff(offsets)
    starts = offsets[:-1] + (order + 1) * np.arange(len(n))
    padded = np.full(len(data) + (order + 1) * len(n), EDGE, np.uint64)
    text = np.ones(len(padded), bool)
    for j in range(order):
        text[starts + j] = False
    text[starts + n + order] = False
    padded[text] = data
    text[starts + n + order] = True  # the end is predicted too
    at = np.flatnonzero(text)
    keys = padded[at]
    for j in range(1, order + 1):
        keys |= padded[at - j] << np.uint64(8 * j)
    return keys, np.concatenate([[0], np.cumsum(n + 1)])


def word_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words and of the end after each text, tokens before each text); ``data`` is in lower case."""
    starts, ends, bounds = textops.word_spans(data, offsets)
    return np.insert(textops.span_hashes(data, starts, ends), bounds[1:], np.uint64(END)), bounds + np.arange(len(bounds))


def _tally(values: list[np.ndarray], learned: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(all distinct values, how often each was among the learned ones, which come as (values, counts))."""
    known, at = np.unique(np.concatenate([v for v, _ in learned]), return_inverse=True)
    keys = np.union1d(known, np.concatenate(values))
    counts = np.zeros(len(keys), np.int64)
    counts[np.searchsorted(keys, known)] = np.bincount(at, np.concatenate([n for _, n in learned]), minlength=len(known))
    return keys, counts


def _packed(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _unpacked(blob, dtype) -> np.ndarray:
    buffer = blob.as_buffer()
    return np.frombuffer(pa.decompress(buffer.slice(8), int.from_bytes(buffer.slice(0, 8).to_pybytes(), "little"), "zstd", asbytes=True), dtype)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as the byte planes of their differences, compressed."""
    return _packed(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def _unpacked_keys(blob) -> np.ndarray:
    planes = _unpacked(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _joined(column, dtype) -> np.ndarray:
    return np.concatenate([_unpacked(b, dtype) for b in column]) if len(column) else np.zeros(0, dtype)


def _joined_keys(column) -> np.ndarray:
    return np.concatenate([_unpacked_keys(b) for b in column]) if len(column) else np.zeros(0, np.uint64)


def _split(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray):
    order = np.argsort(bucket, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        if len(part):
            yield int(bucket[part[0]]), _packed_keys(keys[part]), _packed(counts[part])


def _kind(df: DataFrame) -> str:
    return df.schema["id"].dataType.simpleString()


def _bucket(keys: np.ndarray, kind: str, word_buckets: int) -> np.ndarray:
    return (keys % np.uint64(word_buckets) if kind == "word" else keys >> np.uint64(8) & np.uint64(255)).astype(np.int64)


def _chunks(docs: DataFrame, word_buckets: int, chunk_bytes: int, order: int) -> DataFrame:
    """Rows of three kinds: ``doc`` (some documents of a chunk, their lower-case bytes compressed), ``word`` and ``gram`` (the chunk's counts per bucket)."""
    names = ["kind", "chunk", "ids", "held", "offsets", "blob", "bucket", "keys", "counts"]
    types = [pa.string(), pa.int64(), None, pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def rows_of(n, **columns):
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(names, types, strict=True)], names)

    def run(batches):
        first = TaskContext.get().partitionId() << 24
        seq, size = 0, 0
        seen = {"word": ([], []), "gram": ([], [])}

        def report():
            for kind, (asked, learned) in seen.items():
                keys, counts = _tally(asked, learned)
                bucket, keys, counts = zip(*_split(keys, counts, _bucket(keys, kind, word_buckets)), strict=True)
                yield rows_of(len(keys), kind=[kind] * len(keys), chunk=[first + seq] * len(keys), bucket=bucket, keys=keys, counts=counts)

        for batch in batches:
            types[2] = pa.list_(batch.schema.field("id").type)
            for lo, hi in textops.slices(batch.column("text"), min(chunk_bytes, 1 << 19)):
                part = batch.slice(lo, hi - lo)
                data, offsets = textops.text_bytes(part.column("text"))
                data, learn = textops.LOWER[data], ~part.column("held").to_numpy(zero_copy_only=False)
                for kind, (values, before) in (("word", word_tokens(data, offsets)), ("gram", context_keys(data, offsets, order))):
                    mask = np.repeat(learn, np.diff(before))
                    seen[kind][0].append(np.unique(values[~mask]))
                    seen[kind][1].append(np.unique(values[mask], return_counts=True))
                blob = pa.compress(data.tobytes(), "zstd", asbytes=True)
                yield rows_of(1, kind=["doc"], chunk=[first + seq], ids=[part.column("id").to_pylist()], held=[part.column("held").to_pylist()], offsets=[offsets.tobytes()], blob=[blob])
                size += len(data)
                if size >= chunk_bytes:
                    yield from report()
                    seq, size = seq + 1, 0
                    seen = {"word": ([], []), "gram": ([], [])}
        if size or seen["word"][0]:
            yield from report()

    return docs.mapInArrow(run, f"kind string, chunk long, ids array<{_kind(docs)}>, held array<boolean>, offsets binary, blob binary, bucket int, keys binary, counts binary")


def _merged(counts: DataFrame, chunks: int) -> DataFrame:
    """``bucket, keys, counts`` over all chunks, merged ``FAN`` at a time."""
    def merge(key, table):
        keys, at = np.unique(_joined_keys(table.column("keys")), return_inverse=True)
        total = np.bincount(at, _joined(table.column("counts"), np.int64), minlength=len(keys)).astype(np.int64)
        return pa.table({"part": pa.array([key[1].as_py()], pa.int64()), "bucket": pa.array([key[0].as_py()], pa.int32()), "keys": [_packed_keys(keys)], "counts": [_packed(total)]})

    rows, parts = counts.select(F.col("chunk").alias("part"), "bucket", "keys", "counts"), chunks
    while True:
        parts = -(-parts // FAN)
        rows = rows.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts))).groupBy("bucket", "part").applyInArrow(merge, "part long, bucket int, keys binary, counts binary")
        if parts <= 1:
            return rows.select("bucket", "keys", "counts")


def _answers(requests: DataFrame, model: DataFrame, kind: str, chunks: int) -> DataFrame:
    """``chunk, kind, bucket, answers`` for every request, in the order of its keys; a task answers about ``FAN`` chunks of a bucket."""
    parts = -(-chunks // FAN)
    salted = requests.select("chunk", "bucket", "keys", F.pmod(F.xxhash64("chunk"), F.lit(parts)).alias("part"))
    spread = model.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")))

    def answer(asked, known):
        keys = _joined_keys(known.column("keys"))
        values = _joined(known.column("answers"), np.float64).reshape(-1, max(1, len(keys)))  # a row per order
        out = [_packed(values[:, np.searchsorted(keys, _unpacked_keys(b))]) for b in asked.column("keys")]
        return pa.table({"chunk": asked.column("chunk"), "kind": pa.array([kind] * len(out), pa.string()), "bucket": asked.column("bucket"), "answers": pa.array(out, pa.binary())})

    return salted.groupBy("bucket", "part").cogroup(spread.groupBy("bucket", "part")).applyInArrow(answer, "chunk long, kind string, bucket int, answers binary")


def _answered(keys: np.ndarray, kind: str, word_buckets: int, answers: dict[int, np.ndarray], rows: int) -> np.ndarray:
    """The model's answers (a row per order) to the distinct keys of a chunk, ascending: requests went out in this order per bucket."""
    bucket = _bucket(keys, kind, word_buckets)
    out = np.empty((rows, len(keys)))
    for b in np.unique(bucket):
        out[:, bucket == b] = answers[int(b)].reshape(rows, -1)
    return out


def score_chunk(parts, answers: dict[str, dict[int, np.ndarray]], word_buckets: int, total: int, distinct: int, orders: Sequence[int] = (ORDER,)) -> list[dict]:
    """Scores of the documents of one chunk; ``parts`` are (lower-case bytes, offsets), ``answers`` the model's, by kind and bucket."""
    tokens = [word_tokens(data, offsets) for data, offsets in parts]
    words = np.unique(np.concatenate([np.unique(t) for t, _ in tokens]))
    (word_counts,) = _answered(words, "word", word_buckets, answers["word"], 1)
    held = []  # of each part: its distinct keys, the place of each key among them, keys before each text
    for data, offsets in parts:
        keys, starts = context_keys(data, offsets, max(orders))
        own, at = np.unique(keys, return_inverse=True)
        held.append((own, at.astype(np.int32), starts))
    grams = np.unique(np.concatenate([own for own, _, _ in held]))
    gram_logs = _answered(grams, "gram", word_buckets, answers["gram"], len(orders))
    logs = np.log10(word_counts + 0.1) - math.log10(total + 0.1 * (distinct + 1))
    out = []
    for (token, before), (own, place, starts) in zip(tokens, held, strict=True):
        at, heads = np.searchsorted(words, token), before[:-1]
        found = gram_logs[:, np.searchsorted(grams, own)]
        out.append({
            "n_tokens": np.diff(before),
            "n_known": np.add.reduceat((word_counts[at] > 0).astype(np.int64), heads),
            "base_score": np.add.reduceat(logs[at], heads),
            **{name: np.add.reduceat(row[place], starts[:-1]) for name, row in zip(score_names(orders), found, strict=True)},
        })
    return out


def score_names(orders: Sequence[int]) -> list[str]:
    return ["score" if n == max(orders) else f"score_{n}" for n in orders]


def code_lengths(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES,
                 orders: Sequence[int] = (ORDER,)) -> DataFrame:
    """One row per document: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held`` marks documents that nothing is learned from (null: held out).  ``base_score`` sums, over the words in
    lower case and one end, log10((c + 0.1) / (N + 0.1 (V + 1))); ``score`` is PPM's log10 probability
    of the bytes and the end (the code length in bits is -score / log10(2)) with contexts of up to
    the largest of ``orders`` bytes; each shorter order n adds a column ``score_n``, from the same counts.  A null text is empty:
    one end token.  With no training documents every symbol is equally likely.  Repeated rows are
    scored, and learned from, each for itself; an empty table gives no rows; other columns are not read.
    """
    if not all(0 < n <= ORDER_MAX for n in orders):
        raise ValueError(f"orders must be from 1 to {ORDER_MAX}")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(held, F.lit(True)).alias("held"), text.alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    path = scratch_path(spark, "ppm-chunks")
    word_buckets = max(8, -(-n_bytes // WORD_BUCKET_BYTES))
    _chunks(source, word_buckets, chunk_bytes, max(orders)).write.parquet(path)
    rows = spark.read.parquet(path)
    chunks = rows.where("kind = 'gram'").agg(F.countDistinct("chunk")).first()[0] or 1

    def model(kind):
        path = scratch_path(spark, f"ppm-{kind}s")
        _merged(rows.where(F.col("kind") == kind), chunks).write.parquet(path)
        return spark.read.parquet(path)

    words, grams = model("word"), model("gram")

    def totals(batches):
        for batch in batches:
            n = _joined(batch.column("counts"), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([int(n.sum())]), pa.array([int((n > 0).sum())])], ["n", "v"])

    def symbols(batches):
        for batch in batches:
            n = np.bincount((_joined_keys(batch.column("keys")) & np.uint64(255)).astype(np.int64), _joined(batch.column("counts"), np.int64), minlength=256).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(n)], ["symbol", "n"])

    total, distinct = words.mapInArrow(totals, "n long, v long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    per_symbol = dict(grams.mapInArrow(symbols, "symbol long, n long").groupBy("symbol").agg(F.sum("n")).collect())  # 256 rows
    zero = np.array([per_symbol.get(s, 0) for s in range(256)], np.int64)

    def learned(batches):
        for batch in batches:
            for b, k, n in zip(batch.column("bucket").to_pylist(), batch.column("keys"), batch.column("counts"), strict=True):
                answers = model_answers(_unpacked_keys(k), _unpacked(n, np.int64), zero, orders)
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([k.as_py()]), pa.array([_packed(answers)])], ["bucket", "keys", "answers"])

    def as_floats(batches):
        for batch in batches:
            for b, k, n in zip(batch.column("bucket").to_pylist(), batch.column("keys"), batch.column("counts"), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([k.as_py()]), pa.array([_packed(_unpacked(n, np.int64).astype(np.float64))])], ["bucket", "keys", "answers"])

    answered = "bucket int, keys binary, answers binary"
    found = _answers(rows.where("kind = 'word'"), words.repartition("bucket").mapInArrow(as_floats, answered), "word", chunks).unionByName(
        _answers(rows.where("kind = 'gram'"), grams.repartition("bucket").mapInArrow(learned, answered), "gram", chunks))

    def score(documents, found_):
        answers = {"word": {}, "gram": {}}
        for kind, bucket, blob in zip(found_.column("kind").to_pylist(), found_.column("bucket").to_pylist(), found_.column("answers"), strict=True):
            answers[kind][bucket] = _unpacked(blob, np.float64)
        parts = []
        for offsets, blob in zip(documents.column("offsets"), documents.column("blob"), strict=True):
            offsets = np.frombuffer(offsets.as_buffer(), np.int64)
            parts.append((np.frombuffer(pa.decompress(blob.as_buffer(), int(offsets[-1]), "zstd", asbytes=True), np.uint8), offsets))
        got = score_chunk(parts, answers, word_buckets, total, distinct, orders)
        columns = {name: np.concatenate([g[name] for g in got]) for name in got[0]}
        ids, held_ = (documents.column(c).combine_chunks().flatten() for c in ("ids", "held"))
        return pa.table({"id": ids, "held_out": held_, **columns})

    scores = ", ".join(f"{name} double" for name in score_names(orders))
    documents = rows.where("kind = 'doc'").select("chunk", "ids", "held", "offsets", "blob")
    scored = documents.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        score, f"id {_kind(source)}, held_out boolean, n_tokens long, n_known long, base_score double, {scores}")
    return scored.select("id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", *score_names(orders))


def adaptive_code_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``id, score`` by a model that starts empty at each document and learns as it reads (null text: empty)."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores = [AdaptivePPM(order).read(t.encode(), learn=True) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return source.mapInArrow(run, f"id {_kind(source)}, score double")
