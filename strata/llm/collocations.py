"""Phrase collocations from stripes.

A phrase of k words is a prefix of k-1 words and a next word.  A stripe is a prefix with an
associative counter of its next words.  Every task counts stripes over its texts, stripes of
one prefix are merged elementwise, and what is left of them after the least count gives all
that the ranking needs: the extensions (phrases and their counts), the totals of their parts,
and per prefix or suffix the largest count of a longer phrase, which decides subsumption.

Lengths are counted one after the other.  A phrase can only reach the least count if its
first and its last k-1 words do, so a bitmap of fixed size with the hashes of those goes to
the tasks first; a hash that is in it by chance costs a counter, never a wrong count.

Words are compared by two 64-bit hashes, which include the language.  Stripes of common
prefixes (at most 1,024 of a length can hold a thousandth of all words) are cut by the hash
of the next word, so that no task gets a hot prefix alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import textops
from strata.session import scratch_path

LONGEST = 5
LEAST = 100
TOP = 2000
BITS = 1 << 26  # of the bitmap (8 MB)
CHUNK = 1 << 21  # counted phrases that a task holds before it hands them on (and a sixteenth as many words)
BLOBS = ("prefixes", "lengths", "words", "numbers", "counts")  # a bucket's stripes as a task hands them on
BUCKET = 1 << 22  # counted phrases of a bucket, about
HOT = 1024  # a prefix with this part of all words is hot
SLICES = 64  # pieces of a hot prefix's stripe
SPREAD = 64  # parts of a language when its best phrases are chosen
UNKNOWN = "und"

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BLANK | _BREAK
_SECOND = np.random.default_rng(13).permutation(256).astype(np.uint8)  # the second hash reads other codes for the same bytes
U64 = np.uint64
_STEP = (U64(0xD1B54A32D192ED03), U64(0x8CB92BA72F3D8DD7))


def follow(key: np.ndarray, word: np.ndarray, which: int) -> np.ndarray:
    """Hash of a phrase from those of its prefix and its next word."""
    return textops.mix64(textops.mix64(key * _STEP[which] + U64(which + 1)) + word)


def pieces(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, bounds, piece): byte spans of words, and a number that words of one piece of a text share."""
    inside = ~_GAP[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    heads, tails = edge[edge < len(data)], edge[edge > 0] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    breaks = np.cumsum(_BREAK[data])
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return starts, np.flatnonzero(last) + 1, bounds, breaks[starts] + text


def _hashed(batch):
    """(bytes, starts, ends, bounds, piece, two hashes of every word) of a batch's texts, a slice at a time, with the first row."""
    texts = batch.column("text")
    langs, at = textops.text_bytes(batch.column("lang"))
    seeds = [textops.span_hashes(d, at[:-1], at[1:]) for d in (langs, _SECOND[langs])]
    for lo, hi in textops.slices(texts):
        data, offsets = textops.text_bytes(texts.slice(lo, hi - lo))
        data = textops.LOWER[data]
        starts, ends, bounds, piece = pieces(data, offsets)
        n = np.diff(bounds)
        words = [follow(np.repeat(s[lo:hi], n), textops.span_hashes(d, starts, ends), i) for i, (d, s) in enumerate(zip((data, _SECOND[data]), seeds, strict=True))]
        yield lo, data, starts, ends, bounds, piece, words


class _Numbers:
    """Numbers the distinct hashes that a task meets, so that a counted pair takes eight bytes.

    Inside a task hashes are told apart by their first 64 bits; between tasks by all 128.
    """

    def __init__(self):
        self.sorted, self.order = np.zeros(0, U64), np.zeros(0, np.int64)
        self.first, self.second = np.zeros(0, U64), np.zeros(0, U64)

    def __len__(self) -> int:
        return len(self.first)

    def read(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        unique, at, inverse = np.unique(a, return_index=True, return_inverse=True)
        place = np.searchsorted(self.sorted, unique)
        known = np.zeros(len(unique), bool)
        inside = place < len(self.sorted)
        known[inside] = self.sorted[place[inside]] == unique[inside]
        if not known.all():
            new = ~known
            numbers = len(self.first) + np.arange(new.sum())
            self.first, self.second = np.concatenate([self.first, unique[new]]), np.concatenate([self.second, b[at[new]]])
            self.sorted, self.order = np.insert(self.sorted, place[new], unique[new]), np.insert(self.order, place[new], numbers)
            place = np.searchsorted(self.sorted, unique)
        return self.order[place][inverse]


class _Pairs:
    """Counts pairs of a prefix and a next word, each by its number."""

    def __init__(self):
        self.prefixes, self.words = _Numbers(), _Numbers()
        self.held, self.counts, self.size = [], [], 0

    def add(self, p: np.ndarray, q: np.ndarray, w: np.ndarray, v: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.held.append(self.prefixes.read(p, q) << 32 | self.words.read(w, v))
        self.counts.append(np.ones(len(p), np.int64) if counts is None else counts)
        self.size += len(p)

    def merge(self) -> int:
        """Adds equal pairs up; returns how many there are."""
        if len(self.held) > 1 or self.size:
            pairs, counts = np.concatenate(self.held), np.concatenate(self.counts)
            order = np.argsort(pairs)
            pairs, counts = pairs[order], counts[order]
            head = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
            self.held, self.counts = [pairs[head]], [np.add.reduceat(counts, head) if len(head) else counts]
            self.size = len(head)
        return self.size

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the prefix, number of the next word, count) of all pairs, by prefix."""
        self.merge()
        pairs, counts = (self.held[0], self.counts[0]) if self.held else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pairs >> 32, pairs & 0xFFFFFFFF, counts


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as four planes of bytes: the upper ones are mostly zero, which compresses away."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(blob) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _keys(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Two hashes as 16 bytes."""
    both = np.ascontiguousarray(np.stack([a, b], axis=1))
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer((np.arange(len(a) + 1) * 16).astype(np.int32)), pa.py_buffer(both)])


def _words(docs: DataFrame, held_most: int) -> DataFrame:
    """``lang, word, n``: every distinct word of a language, and its occurrences."""

    def run(batches):
        held: dict[str, dict[bytes, int]] = {}
        size = 0

        def out():
            for lang, words in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array([w.decode() for w in words]), pa.array(words.values(), pa.int64())], ["lang", "word", "n"])
            held.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lo, data, starts, ends, bounds, _, (a, b) in _hashed(batch):
                raw, n = data.tobytes(), np.diff(bounds)
                counts, where = _first_places(a, b)
                owner = np.repeat(np.arange(len(n)), n)[where] + lo  # hashes include the language
                for s, e, row, c in zip(starts[where].tolist(), ends[where].tolist(), owner.tolist(), counts.tolist(), strict=True):
                    words = held.setdefault(langs[row], {})
                    word = raw[s:e]
                    if word in words:
                        words[word] += c
                    else:
                        words[word] = c
                        size += 1
                if size >= held_most:
                    yield from out()
                    size = 0
        yield from out()

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _keyed(words: DataFrame) -> DataFrame:
    """Adds ``key``, the two hashes of a word in its language, to ``lang, phrase``."""

    def run(batches):
        for batch in batches:
            at = [words for *_, words in _hashed(pa.RecordBatch.from_arrays([batch.column("phrase"), batch.column("lang")], ["text", "lang"]))]
            keys = [np.concatenate([w[i] for w in at]) if at else np.zeros(0, U64) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _keys(*keys)], [*batch.schema.names, "key"])

    return words.mapInArrow(run, "lang string, phrase string, f long, key binary")


def _first_places(a: np.ndarray, b: np.ndarray):
    """Of distinct pairs of hashes: their counts, and where each stands."""
    if not len(a):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    head = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
    return np.diff(np.append(head, len(a))), order[head]


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of the keys' first hash modulo a fixed size, gathered in bitmaps of 4 KB: at most 8 MB, whatever the input."""
    low = sum(F.conv(F.hex(F.substring("key", i + 1, 1)), 16, 10).cast("long") * F.lit(1 << 8 * i) for i in range(4))
    at = F.pmod(low, F.lit(BITS)) + 1  # Spark numbers bits and buckets from 1
    maps = keys.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(BITS // 8, np.uint8)
    for b, blob in maps.collect():
        bits[(b - 1) * 4096 : b * 4096] |= np.frombuffer(bytes(blob), np.uint8)
    return bits


def _holds(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = (key % U64(BITS)).astype(np.int64)
    return bits[at // 8] >> (at % 8).astype(np.uint8) & 1 > 0


def _stripes(docs: DataFrame, k: int, known: np.ndarray, hot: np.ndarray, total: int, least: int, chunk: int) -> DataFrame:
    """``prefix, next, n`` (arrays of 16-byte keys and counts): the stripes of all prefixes of k-1 words, merged, entries under ``least`` left out.

    A hot prefix comes in several rows.  ``known`` are the bits of the shorter phrases, ``hot`` the first hashes of hot prefixes.
    """
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast((known, np.sort(hot)))
    buckets = int(max(1, -(-total // BUCKET)))

    def count(batches):
        known, hot = given.value
        pairs = _Pairs()

        def out(pairs):
            """Stripes in one row per bucket: prefixes, the lengths of their stripes, words, next words, counts."""
            p, w, n = pairs.rows()
            first, second = pairs.prefixes.first, pairs.prefixes.second
            part = np.where(np.isin(first, hot)[p], pairs.words.first[w] % U64(SLICES), U64(0))
            bucket = (textops.mix64(first[p] + part * _STEP[0]) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # prefixes stay together
            p, w, n, bucket = (x[order] for x in (p, w, n, bucket))
            ends = np.flatnonzero(np.diff(bucket, append=-1)) + 1
            rows = []
            for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True) if len(p) else ():
                head = np.flatnonzero(np.concatenate([[True], p[lo + 1 : hi] != p[lo : hi - 1]])) + lo
                own, number = np.unique(w[lo:hi], return_inverse=True)  # next words as numbers of the bucket's own list
                rows.append((int(bucket[lo]), first[p[head]].tobytes() + second[p[head]].tobytes(), _planes(np.diff(np.append(head, hi))),
                             pairs.words.first[own].tobytes() + pairs.words.second[own].tobytes(), _planes(number), _planes(n[lo:hi])))
                if len(rows) == 16:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

        def batch_of(rows):
            kinds = (pa.int64(), *[pa.binary()] * 5)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", *BLOBS])

        for batch in batches:
            for _, _, _, _, _, piece, words in _hashed(batch):
                m = len(piece) - k + 1
                if m < 1:
                    continue
                inner = [w.copy() for w in words]  # the phrases of k-1 words that start at each word
                for j in range(1, k - 1):
                    inner = [follow(x[: len(x) - 1], w[j:][: len(x) - 1], i) for i, (x, w) in enumerate(zip(inner, words, strict=True))]
                fine = _holds(known, inner[0])
                at = np.flatnonzero(fine[:m] & fine[1 : m + 1] & (piece[:m] == piece[k - 1 :]))
                if len(at):
                    pairs.add(inner[0][at], inner[1][at], words[0][at + k - 1], words[1][at + k - 1])
                if pairs.size >= 2 * chunk and pairs.merge() >= chunk:
                    yield from out(pairs)
                    pairs = _Pairs()
        yield from out(pairs)

    def merge(table: pa.Table) -> pa.Table:
        pairs = _Pairs()
        for blobs in zip(*(table.column(c) for c in BLOBS), strict=True):
            prefixes, lengths, words, numbers, n = (b.as_buffer() for b in blobs)
            lengths, numbers = _unplaned(lengths), _unplaned(numbers)
            (p, q), (w, v) = (np.frombuffer(b, U64).reshape(2, -1) for b in (prefixes, words))
            pairs.held.append(np.repeat(pairs.prefixes.read(p, q), lengths) << 32 | pairs.words.read(w, v)[numbers])
            pairs.counts.append(_unplaned(n).astype(np.int64))
            pairs.size += len(numbers)
            if pairs.size >= 2 * BUCKET:
                pairs.merge()
        p, w, n = pairs.rows()
        some = n >= least
        p, w, n = p[some], w[some], n[some]
        head = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]])) if len(p) else np.zeros(0, np.int64)
        offsets = pa.array(np.append(head, len(p)).astype(np.int32))
        first, second = ((x.first[i], x.second[i]) for x, i in ((pairs.prefixes, p[head]), (pairs.words, w)))
        return pa.table([_keys(*first), pa.ListArray.from_arrays(offsets, _keys(*second)), pa.ListArray.from_arrays(offsets, pa.array(n))], ["prefix", "next", "n"])

    dealt = docs.mapInArrow(count, "bucket long, " + ", ".join(f"{b} binary" for b in BLOBS))
    return dealt.groupBy("bucket").applyInArrow(merge, "prefix binary, next array<binary>, n array<long>")


def _extended(stripes: DataFrame, shorter: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, phrase, key, f``: the entries of stripes as phrases."""

    def run(batches):
        for batch in batches:
            (a, b), (w, v) = (np.frombuffer(b"".join(x.as_py() for x in batch.column(c)), U64).reshape(-1, 2).T for c in ("prefix", "next"))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("phrase"), _keys(follow(a, w, 0), follow(b, v, 1)), batch.column("f")], ["lang", "phrase", "key", "f"])

    entries = stripes.select("prefix", F.explode(F.arrays_zip("next", "n")).alias("e")).select("prefix", F.col("e.next").alias("next"), F.col("e.n").alias("f"))
    named = entries.join(shorter.select(F.col("key").alias("prefix"), "lang", F.col("phrase").alias("head")), "prefix")
    named = named.join(words.select(F.col("key").alias("next"), F.col("phrase").alias("tail")), "next")
    rows = named.select("prefix", "next", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "f")
    return rows.mapInArrow(run, "lang string, phrase string, key binary, f long")


def _cuts(k: int, words) -> list:
    return [F.struct(F.lit(j).alias("k"), F.array_join(F.slice(words, 1, j), " ").alias("left"), F.array_join(F.slice(words, j + 1, k - j), " ").alias("right")) for j in range(1, k)]


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP, chunk: int = CHUNK) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of two to ``longest`` words.

    A phrase counts when it occurs ``least`` times or more inside pieces of texts, overlaps included,
    and no longer one that holds its words occurs as often.  Of its cuts the one with the lowest
    ``floor(1000 * a * n / (l * r))`` counts, the earliest of equal ones.  Null and empty texts have no
    words; a null language is ``und``, together with rows that say so.  Rows that repeat count as often
    as they occur.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession

    def written(df, name):
        path = scratch_path(spark, f"collocations-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    counted = written(_words(docs, max(1, chunk // 16)), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 0
    words = written(_keyed(counted.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))), "phrases-1")

    levels = [words]
    for k in range(2, longest + 1):
        shorter = levels[-1]
        # At most HOT phrases can hold that part of all words each.
        hot = [int.from_bytes(bytes(r["key"])[:8], "little") for r in shorter.where(F.col("f") * HOT > total).select("key").collect()]
        stripes = written(_stripes(docs, k, _bitmap(shorter), np.array(hot, U64), total, least, chunk), f"stripes-{k}")
        levels.append(written(_extended(stripes, shorter, words), f"phrases-{k}"))
        if levels[-1].isEmpty():
            break

    phrases = levels[0].select("lang", "phrase", "f")
    found = []
    for k, level in enumerate(levels[1:], 2):
        phrases = phrases.unionByName(level.select("lang", "phrase", "f"))
        found.append(level.select("lang", "phrase", "f", F.split("phrase", " ").alias("words"), F.lit(k).alias("k")))
    candidates = found[0]
    for level in found[1:]:
        candidates = candidates.unionByName(level)

    # The largest count of a phrase that is one word longer; a still longer one that occurs as often has such a one inside.
    inner = F.array(*[F.struct(F.array_join(F.slice("words", at, F.col("k") - 1), " ").alias("part")) for at in (1, 2)])
    covers = candidates.where("k > 2").select("lang", "f", F.explode(inner).alias("i")).groupBy("lang", F.col("i.part").alias("phrase")).agg(F.max("f").alias("most"))
    kept = candidates.join(covers, ["lang", "phrase"], "left").where("most IS NULL OR most < f").drop("most")

    cuts = None
    for k in range(2, longest + 1):
        part = kept.where(F.col("k") == k).select("lang", "phrase", "f", F.explode(F.array(*_cuts(k, F.col("words")))).alias("c"))
        cuts = part if cuts is None else cuts.unionByName(part)
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), F.col("c.k").alias("k"), F.col("c.left").alias("left"), F.col("c.right").alias("right"))
    counts = written(phrases, "counts")
    scored = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    scored = scored.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
    wide = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * F.col("n").cast("decimal(18,0)")
    scored = scored.withColumn("wide", wide).withColumn("under", F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)"))
    scored = scored.withColumn("score", F.expr("wide div under"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    spread = spread.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= top)
    ranked = spread.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

