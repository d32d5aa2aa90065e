"""N-gram Jaccard join with set-relation skipping.

Every text becomes the set of its hashed word shingles; equal sets are one class.
Two classes link when their Jaccard similarity reaches the threshold, and all
documents of linked classes are one component.

The join is an exact prefix-filter join: ordered by corpus frequency, two similar
sets share a shingle in their first ``n - ceil(t n) + 1``.  Index lists map a
shingle to the sets that have it there.  What could be large is skipped by what is
already known of sets:

* Answers carry over between highly similar sets.  Sets are first compared with the
  central set of their neighbourhood (found through their smallest hashes).  Whoever
  links takes over its component.  Where some are near it without linking, all pairs of
  the neighbourhood are compared in blocks, by one product over shared shingles.
* Lists are ordered by set size.  A probe leaves a list at the first set that is too
  large, and an index of the next entry of another neighbourhood lets it jump over whole
  blocks of sets whose answers are known.  A place in the prefix bounds the overlap,
  which rules out pairs without comparing.
* Bitmaps of a bit per shingle bound the difference of two sets from below and rule out most pairs
  that only share a passage.  Every pair that is left is compared on its full sets.

Frequencies are counted over all texts: a shingle in a given share of all shingles
has that share in at least one chunk of them, so chunks report what they hold several
times.  The most frequent go to the workers as a table of bounded size; frequency
only orders the shingles, any order gives the same answers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.components import components
from strata.session import scratch_path

HEAVY = 1 << 19  # most entries of the frequency table that goes to the workers (8 MB)
CHUNK = 1 << 21  # shingles counted together
LIST_MAX = 1 << 17  # index lists beyond this are dealt over several tasks
BUCKET = 1 << 20  # prefix shingles in a bucket of index lists
BLOOM_BITS = 1 << 26
PARTNERS = 10_000  # sets compared with one other in a task
HOOD_BLOCK = 256  # sets of a neighbourhood compared with as many others in a task
PROBES = 1 << 19  # index entries probed, and pairs held, at a time
SKETCH = 4  # smallest hashes by which a set finds a central set


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _i64(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each segment (wraps modulo 2**64 for integers)."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def fingerprints(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of every set of hashes, as two longs."""
    mixed = textops.mix64(tokens ^ np.uint64(0xA0761D6478BD642F))
    return _sums(mixed, bounds).view(np.int64), _sums(mixed * mixed ^ mixed >> np.uint64(32), bounds).view(np.int64)


def _sets(batch, column: str, k: int):
    """(first row, tokens, bounds) of a batch's texts, a slice at a time."""
    texts = batch.column(column)
    for lo, hi in textops.slices(texts):
        yield lo, *textops.shingles(*textops.text_bytes(texts.slice(lo, hi - lo)), k)


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Segments of an array as one binary each."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _pick(values: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, bounds) of some of the segments."""
    n = np.diff(bounds)[rows]
    before = np.concatenate([[0], np.cumsum(n)])
    return values[np.arange(before[-1]) + np.repeat(bounds[rows] - before[:-1], n)], before


class Order:
    """The global order of shingles: by reported frequency, then by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        at = np.argsort(tokens)
        self.tokens, self.counts = tokens[at], counts[at]

    def frequency(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)


def _profile(docs: DataFrame, k: int) -> DataFrame:
    """First pass: ``id, n, f1, f2`` of every document, and ``token, reported`` of what a chunk holds more than once."""

    @textops.tidy
    def run(batches):
        held, size = [], 0

        def report():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return values[often], counts[often]

        def frequent(values, counts, kind):
            return pa.RecordBatch.from_arrays([*(pa.nulls(len(values), t) for t in (kind, pa.int32(), pa.int64(), pa.int64())), pa.array(_i64(values)), pa.array(counts.astype(np.int64))], names)

        names = ["id", "n", "f1", "f2", "token", "reported"]
        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field("id").type
            for lo, tokens, bounds in _sets(batch, "text", k):
                f1, f2 = fingerprints(tokens, bounds)
                nothing = pa.nulls(len(f1), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, len(f1)), pa.array(np.diff(bounds).astype(np.int32)), pa.array(f1), pa.array(f2), nothing, nothing], names)
                held.append(tokens)
                size += len(tokens)
                if size >= CHUNK:
                    yield frequent(*report(), kind)
                    held, size = [], 0
        if held:
            yield frequent(*report(), kind)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n int, f1 long, f2 long, token long, reported long")


def _global_order(reports: DataFrame, most: int) -> Order:
    """The most reported shingles, at most ``most`` of them: all those from the least power of two that keeps the bound."""
    totals = reports.groupBy("token").agg(F.sum("reported").alias("c"))
    totals = _written(totals, "jaccard-frequent")
    levels = dict(totals.groupBy(F.floor(F.log2("c")).alias("level")).count().collect())  # at most 64 rows
    least, seen = 64, 0
    for level in sorted(levels, reverse=True):
        seen += levels[level]
        if seen > most:
            break
        least = level
    rows = totals.where(F.floor(F.log2("c")) >= least).select("token", "c").toArrow()
    return Order(*(rows.column(c).to_numpy().astype(np.int64).view(t) for c, t in (("token", np.uint64), ("c", np.int64))))


def bitmaps(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds): per set a bitmap of about a bit per token, each token flipping the bit of its low bits."""
    n = np.diff(bounds)
    bits = 1 << np.maximum(8, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    before = np.concatenate([[0], np.cumsum(bits)])
    at = (tokens & np.repeat(bits - 1, n).astype(np.uint64)).astype(np.int64) + np.repeat(before[:-1], n)
    return np.packbits(np.bincount(at, minlength=before[-1]).astype(np.uint8) & 1, bitorder="little"), before // 8


def least_difference(u: np.ndarray, v: np.ndarray) -> int:
    """Bits in which two bitmaps differ, the longer one folded: no more than the tokens in which their sets differ."""
    if len(u) < len(v):
        u, v = v, u
    while len(u) > len(v):
        half = len(u) // 2
        u = u[:half] ^ u[half:]
    return int(np.bitwise_count(u ^ v).sum())


def _prefixes(docs: DataFrame, order, k: int, num: int, den: int) -> DataFrame:
    """Second pass: ``n, f1, f2, prefix, sketch, central, bits`` of every document with words.

    ``prefix`` are its first shingles in the global order; ``sketch`` its smallest hashes;
    ``central`` grows with how much of the set is frequent, which marks the set that others resemble;
    ``bits`` is its bitmap.
    """

    @textops.tidy
    def run(batches):
        for batch in batches:
            for _, tokens, bounds in _sets(batch, "text", k):
                f1, f2 = fingerprints(tokens, bounds)
                n = np.diff(bounds)
                often = order.value.frequency(tokens)
                central = _sums(np.log1p(often), bounds) / np.maximum(n, 1)
                owner = np.repeat(np.arange(len(n)), n)
                ranked = tokens[np.lexsort((often, owner))] if often.any() else tokens  # stable: equal ones stay ordered by hash
                length = np.where(n > 0, n - -(-n * num // den) + 1, 0)
                place = np.arange(len(tokens)) - np.repeat(bounds[:-1], n)
                prefix, ends = ranked[place < length[owner]], np.concatenate([[0], np.cumsum(length)])
                small = place < SKETCH
                sketch = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.minimum(n, SKETCH))]).astype(np.int32)), pa.array(_i64(tokens[small])))
                columns = [pa.array(n.astype(np.int32)), pa.array(f1), pa.array(f2), _blobs(prefix, ends), sketch, pa.array(central), _blobs(*bitmaps(tokens, bounds))]
                rows = pa.RecordBatch.from_arrays(columns, ["n", "f1", "f2", "prefix", "sketch", "central", "bits"])
                yield rows.filter(pa.array(n > 0))

    return docs.mapInArrow(run, "n int, f1 long, f2 long, prefix binary, sketch array<long>, central double, bits binary")


def _bloom(keys: DataFrame) -> np.ndarray:
    """Bits of ``f1`` modulo a fixed size, gathered in bitmaps of 4 KB: at most 8 MB, whatever the input."""
    at = F.pmod("f1", F.lit(BLOOM_BITS)) + 1  # Spark numbers bits and buckets from 1
    maps = keys.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    for b, blob in maps.collect():
        bits[(b - 1) * 4096 : b * 4096] |= np.frombuffer(bytes(blob), np.uint8)
    return bits


def _promising(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose bitmaps don't rule them out: similar sets differ in few tokens, so their bitmaps in few bits."""

    @textops.tidy
    def run(batches):
        for batch in batches:
            keep = []
            for x, y, m, n in zip(batch.column("x"), batch.column("y"), batch.column("m").to_pylist(), batch.column("n").to_pylist(), strict=True):
                differ = least_difference(*(np.frombuffer(b.as_buffer(), np.uint8) for b in (x, y)))
                keep.append((num + den) * differ <= (den - num) * (m + n))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    x = sets.select(F.col("sid").alias("a"), F.col("n").alias("m"), F.col("bits").alias("x"))
    y = sets.select(F.col("sid").alias("b"), "n", F.col("bits").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "m", "n").mapInArrow(run, "a long, b long")


def _gather(docs: DataFrame, sets: DataFrame, roles: DataFrame, k: int) -> DataFrame:
    """``group, part, role, sid, tokens``, by group, part and role inside partitions, for ``roles(sid, group, part, role)``.

    Sets are worked out from the texts again; a bitmap of the wanted ones leaves the others out
    before the shuffle.
    """
    spark = docs.sparkSession
    wanted = _written(sets.select("sid", "n", "f1", "f2").join(roles, "sid"), "jaccard-wanted")
    bits = spark.sparkContext.broadcast(_bloom(wanted))

    @textops.tidy
    def scan(batches):
        for batch in batches:
            for _, tokens, bounds in _sets(batch, "text", k):
                f1, f2 = fingerprints(tokens, bounds)
                at = f1 % BLOOM_BITS
                rows = np.flatnonzero((np.diff(bounds) > 0) & (bits.value[at // 8] >> (at % 8).astype(np.uint8) & 1 > 0))
                if len(rows):
                    picked, ends = _pick(tokens, bounds, rows)
                    yield pa.RecordBatch.from_arrays([pa.array(np.diff(ends).astype(np.int32)), pa.array(f1[rows]), pa.array(f2[rows]), _blobs(picked, ends)], ["n", "f1", "f2", "tokens"])

    found = docs.select("text").mapInArrow(scan, "n int, f1 long, f2 long, tokens binary")
    one = found.groupBy("n", "f1", "f2").agg(F.first("tokens").alias("tokens"))
    placed = one.join(wanted, ["n", "f1", "f2"]).select("group", "part", "role", "sid", "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(n, "group", "part").sortWithinPartitions("group", "part", "role", "sid")


def _compared(docs: DataFrame, sets: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``a, b, linked`` of the pairs whose full sets reach the threshold (linked) or at least half of it.

    Every ``b`` goes first to where its ``a`` sets are compared with it, one after the other, so a
    task holds one set; a ``b`` with very many partners is dealt over several tasks.
    """
    parts = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    dealt = _written(pairs.join(parts, "b").select("a", "b", F.pmod(F.xxhash64("a"), "parts").alias("part")), "jaccard-dealt")
    roles = dealt.select(F.col("a").alias("sid"), F.col("b").alias("group"), "part", F.lit(1).alias("role")).unionByName(
        dealt.select(F.col("b").alias("sid"), F.col("b").alias("group"), "part", F.lit(0).alias("role")).distinct())

    @textops.tidy
    def compare(batches):
        held, group = np.zeros(0, np.uint64), None
        for batch in batches:
            near, linked = [], []
            for b, role, blob in zip(batch.column("group").to_pylist(), batch.column("role").to_pylist(), batch.column("tokens"), strict=True):
                tokens = np.frombuffer(blob.as_buffer(), np.uint64)
                if role == 0:
                    held, group = tokens.copy(), b
                    near.append(False)
                    continue
                if group != b:
                    raise ValueError("a set came before the one that it is compared with")
                both = len(np.intersect1d(held, tokens, assume_unique=True))
                union = len(held) + len(tokens) - both
                near.append(2 * den * both >= num * union)
                if near[-1]:
                    linked.append(den * both >= num * union)
            kept = batch.filter(pa.array(near, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("sid"), kept.column("group"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return _gather(docs, sets, roles, k).mapInArrow(compare, "a long, b long, linked boolean")


def tile_links(tokens: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets, by one matrix product over the tokens that two of them share."""
    n = np.array([len(t) for t in tokens])
    values, at, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(n)), n)
    some = counts[at] > 1
    matrix = np.zeros((len(n), int((counts > 1).sum())), np.float32)
    matrix[owner[some], shared[at[some]]] = 1
    both = np.rint(matrix @ matrix.T).astype(np.int64)
    link = den * both >= num * (n[:, None] + n[None, :] - both)
    label = np.arange(len(n))
    while True:
        least = np.where(link, label[None, :], len(n)).min(axis=1)
        least = np.minimum(label, least)
        if (least == label).all():
            return [(i, int(j)) for i, j in enumerate(label) if i != j]
        label = least[least]


def _hoods(docs: DataFrame, sets: DataFrame, members: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links ``a, b`` among the members ``sid, hood`` of every neighbourhood, all pairs of it compared.

    A neighbourhood is cut into blocks; a task compares two blocks with each other.
    """
    sizes = members.groupBy("hood").agg(F.ceil(F.count(F.lit(1)) / HOOD_BLOCK).alias("blocks"))
    dealt = members.join(sizes, "hood").withColumn("own", F.pmod(F.xxhash64("sid"), "blocks"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    part = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    roles = other.select("sid", F.col("hood").alias("group"), part.alias("part"), F.lit(1).alias("role"))

    @textops.tidy
    def meet(batches):
        held, tile = [], None

        def links():
            pairs = tile_links([t for _, t in held], num, den) if len(held) > 1 else []
            a, b = ([held[p[c]][0] for p in pairs] for c in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            for group, part, sid, blob in zip(*(batch.column(c).to_pylist() for c in ("group", "part", "sid")), batch.column("tokens"), strict=True):
                if tile != (group, part):
                    if held:
                        yield links()
                    held, tile = [], (group, part)
                held.append((sid, np.frombuffer(blob.as_buffer(), np.uint64).copy()))
        if held:
            yield links()

    return _gather(docs, sets, roles, k).mapInArrow(meet, "a long, b long")


def _central_pairs(sets: DataFrame) -> DataFrame:
    """``a, b``: each set with the most central set that it meets under most of its smallest hashes."""
    near = sets.select("sid", "central", F.explode("sketch").alias("token"))
    centre = near.groupBy("token").agg(F.max(F.struct("central", "sid")).alias("c"), F.count(F.lit(1)).alias("m")).where("m > 1").select("token", F.col("c.sid").alias("b"))
    votes = near.join(centre, "token").where("sid != b").groupBy(F.col("sid").alias("a"), "b").count()
    return votes.groupBy("a").agg(F.max(F.struct("count", "b")).alias("v")).select("a", F.col("v.b").alias("b"))


def list_pairs(token, sid, size, place, label, hood, num: int, den: int):
    """Pairs of sets that meet in an index list, may reach the threshold, and whose answer isn't known.

    Answers are known inside a neighbourhood (``hood``) and inside a component (``label``).
    """
    n = len(token)
    if not n:  # no list holds two sets
        return np.zeros((2, 0), np.int64)
    order = np.lexsort((sid, hood, size, token))
    token, sid, size, place, label, hood = (x[order] for x in (token, sid, size, place, label, hood))
    out = [np.zeros((2, 0), np.int64)]
    held = 0
    first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    # Where the run of one neighbourhood that an entry stands in ends: the block a probe of it jumps over.
    change = np.flatnonzero(np.concatenate([(token[1:] != token[:-1]) | (hood[1:] != hood[:-1]), [True]])) + 1
    jump = np.repeat(change, np.diff(np.concatenate([[0], change])))
    for lo in range(0, n, PROBES):
        probe, at = np.arange(lo, min(lo + PROBES, n)), jump[lo : lo + PROBES].copy()
        while len(probe):
            inside = at < end[probe]
            probe, at = probe[inside], at[inside]
            inside = den * size[probe] >= num * size[at]  # lists are ordered by size: beyond this all are too large
            probe, at = probe[inside], at[inside]
            other = hood[probe] != hood[at]
            p, q = probe[other], at[other]
            # This is the first shingle that the two share, or the pair is found at an earlier one.
            most = np.minimum(size[p] - place[p], size[q] - place[q])
            fits = ((num + den) * most >= num * (size[p] + size[q])) & (label[p] != label[q])
            if fits.any():
                a, b = sid[p[fits]], sid[q[fits]]
                out.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                held += len(a)
                if held > PROBES:
                    out = [np.unique(np.concatenate(out, axis=1), axis=1)]
                    held = 0
            at = np.where(other, at + 1, jump[at])
    return np.unique(np.concatenate(out, axis=1), axis=1)


def _candidates(sets: DataFrame, order: Order, labels: DataFrame, hoods: DataFrame, n_postings: int, num: int, den: int, list_max: int) -> DataFrame:
    """Distinct pairs ``a < b`` of different components from all index lists."""
    spark = sets.sparkSession
    labelled = sets.join(labels.select(F.col("node").alias("sid"), "component"), "sid", "left").join(hoods, "sid", "left")
    labelled = labelled.select("sid", "n", "prefix", F.coalesce("component", "sid").alias("label"), F.coalesce("hood", -1 - F.col("sid")).alias("hood"))
    big = order.counts > list_max
    parts = spark.sparkContext.broadcast((order.tokens[big], -(-order.counts[big] // list_max)))
    skip = None
    if big.any():  # lists of one component need no pairs: a minimum and a maximum per list, for the few large ones
        @textops.tidy
        def postings(batches):
            tokens, _ = parts.value
            for batch in batches:
                for label, blob in zip(batch.column("label").to_pylist(), batch.column("prefix"), strict=True):
                    hit = np.intersect1d(np.frombuffer(blob.as_buffer(), np.uint64), tokens)
                    yield pa.RecordBatch.from_arrays([pa.array(_i64(hit)), pa.array(np.full(len(hit), label, np.int64))], ["token", "label"])

        spread = labelled.mapInArrow(postings, "token long, label long").groupBy("token").agg((F.min("label") == F.max("label")).alias("one")).where("one")
        skip = np.sort(spread.select("token").toArrow().column("token").to_numpy().astype(np.int64).view(np.uint64))  # among at most HEAVY
    skip = spark.sparkContext.broadcast(np.zeros(0, np.uint64) if skip is None else skip)
    buckets = max(1, -(-n_postings // BUCKET), spark.sparkContext.defaultParallelism)

    @textops.tidy
    def deal(batches):
        """Prefixes to index entries, in one blob per bucket and batch."""
        tokens_big, groups = parts.value
        for batch in batches:
            for lo in range(0, len(batch), 4000):
                part = batch.slice(lo, 4000)
                blobs = [np.frombuffer(b.as_buffer(), np.uint64) for b in part.column("prefix")]
                counts = np.array([len(b) for b in blobs])
                token, owner = np.concatenate(blobs), np.repeat(np.arange(len(blobs)), counts)
                place = np.arange(len(token)) - np.repeat(np.cumsum(counts) - counts, counts)
                if len(tokens_big):
                    some = ~np.isin(token, skip.value)
                    token, owner, place = split_large(token[some], owner[some], place[some], tokens_big, groups)
                where = (textops.mix64(token) % np.uint64(buckets)).astype(np.int64)
                order_ = np.lexsort((owner, where))
                token, owner, place, where = token[order_], owner[order_], place[order_], where[order_]
                columns = [part.column(c).to_numpy(zero_copy_only=False) for c in ("sid", "n", "label", "hood")]
                ends = np.flatnonzero(np.diff(where, append=-1)) + 1
                out = []
                for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
                    present, n = np.unique(owner[a:b], return_counts=True)
                    sets_ = np.stack([*(c[present] for c in columns), n]).astype(np.int64)
                    # list keys of 32 bits: two lists that share one only bring pairs that the comparison rules out
                    out.append((int(where[a]), (token[a:b] >> np.uint64(32)).astype(np.uint32).tobytes(), place[a:b].astype(np.uint32).tobytes(), sets_.tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["bucket", "tokens", "places", "sets"])

    def split_large(token, owner, place, tokens_big, groups):
        """A large list is dealt into groups; every two groups meet in a list of their own, so no pair is lost."""
        at = np.minimum(np.searchsorted(tokens_big, token), len(tokens_big) - 1)
        large = np.flatnonzero(tokens_big[at] == token)
        out = [(np.delete(token, large), np.delete(owner, large), np.delete(place, large))]
        for i in large.tolist():
            g = int(groups[at[i]])
            own = int(textops.mix64(np.array([owner[i]], np.uint64) + token[i])[0] % np.uint64(g))
            lo, hi = np.minimum(own, np.arange(g)), np.maximum(own, np.arange(g))
            lists = textops.mix64(token[i] + (lo * g + hi + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            out.append((lists, np.full(g, owner[i]), np.full(g, place[i])))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def meet(key, table):
        entries = [[], [], [], [], [], []]
        for tokens, places, sets_ in zip(table.column("tokens"), table.column("places"), table.column("sets"), strict=True):
            sid, n, label, hood, count = np.frombuffer(sets_.as_buffer(), np.int64).reshape(5, -1)
            for held, values in zip(entries, (np.frombuffer(tokens.as_buffer(), np.uint32), np.repeat(sid, count), np.repeat(n, count),
                                              np.frombuffer(places.as_buffer(), np.uint32).astype(np.int64), np.repeat(label, count), np.repeat(hood, count)), strict=True):
                held.append(values)
        token = np.concatenate(entries[0])
        ranked = np.sort(token)
        shared = np.isin(token, ranked[1:][ranked[1:] == ranked[:-1]])  # lists of one entry have no pairs
        a, b = list_pairs(token[shared], *(np.concatenate(e)[shared] for e in entries[1:]), num, den)
        return pa.table({"a": a, "b": b})

    dealt = labelled.mapInArrow(deal, "bucket long, tokens binary, places binary, sets binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100, list_max: int = LIST_MAX) -> DataFrame:
    """One row per document: ``id, n_shingles, component_id`` (the smallest id of its component).

    Sets link when ``den * intersection >= num * union``.  Empty and null texts, and texts without
    words, have no shingles and link with nothing: their component is their own id.  Documents of
    equal sets are linked whether or not they are joined pair by pair.  Null ids take part and never
    become a component's id unless it has no other; rows that repeat count as equal sets.  An empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    profile = _written(_profile(docs, k), "jaccard-profile")
    members = profile.where("n IS NOT NULL").select("id", "n", "f1", "f2")
    order = _global_order(profile.where("token IS NOT NULL").select("token", "reported"), HEAVY)
    shared_order = spark.sparkContext.broadcast(order)

    prefixes = _prefixes(docs.select("text"), shared_order, k, num, den)
    one = prefixes.groupBy("n", "f1", "f2").agg(F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch"), F.first("central").alias("central"), F.first("bits").alias("bits"))
    sets = _written(one.withColumn("sid", F.monotonically_increasing_id()), "jaccard-sets")

    def joined(links):
        return components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    # Each set and the central set of its neighbourhood; who is near it but not linked is compared with all others there.
    near = _written(_compared(docs, sets, _written(_promising(_central_pairs(sets), sets, num, 2 * den), "jaccard-pairs"), k, num, den), "jaccard-near")
    links = near.where("linked").select("a", "b")
    unsettled = near.where("NOT linked").select("b").distinct()
    hoods = _written(near.join(unsettled, "b", "left_semi").select(F.col("a").alias("sid"), F.col("b").alias("hood")), "jaccard-hoods")
    links = links.unionByName(_written(_hoods(docs, sets, hoods, k, num, den), "jaccard-links"))
    labels = _written(joined(links), "jaccard-labels")
    n_postings = sets.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    pairs = _candidates(sets, order, labels, hoods, int(n_postings), num, den, list_max)
    pairs = _written(_promising(pairs, sets, num, den), "jaccard-pairs")
    links = links.unionByName(_written(_compared(docs, sets, pairs, k, num, den), "jaccard-links").where("linked").select("a", "b"))
    labels = joined(links)

    classes = sets.join(labels, F.col("sid") == F.col("node"), "left").select("n", "f1", "f2", F.coalesce("component", "sid").alias("label"))
    lows = members.where("n > 0").groupBy("n", "f1", "f2").agg(F.min("id").alias("low"))
    lows = _written(lows.join(classes, ["n", "f1", "f2"]), "jaccard-classes")
    least = lows.groupBy("label").agg(F.min("low").alias("component_id"))
    named = lows.join(least, "label").select("n", "f1", "f2", "component_id")
    linked = members.where("n > 0").join(named, ["n", "f1", "f2"])
    alone = members.where("n = 0").select("id", F.col("n").cast("long").alias("n_shingles"), F.col("id").alias("component_id"))
    return linked.select("id", F.col("n").cast("long").alias("n_shingles"), "component_id").unionByName(alone)
