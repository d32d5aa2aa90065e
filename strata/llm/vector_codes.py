"""Product-quantisation codes with LAESA pivots.

Vectors become integers, are cut into equal parts, and every part position gets a codebook by
rounds of nearest-entry assignment and componentwise means, all in exact integers.

Looking up the nearest entry follows LAESA.  A few pivots per part position are fixed at the
start, and the distances of all parts to them are computed once and stored with the parts.  In
a round only the distances of the pivots to the codebook's entries are new.  By the triangle
inequality the largest difference of two such distances bounds the distance of a part to an
entry from below.  The entry with the lowest bound is evaluated first; those whose bound is above
its distance are never evaluated.  Bounds are kept in 32-bit floats with room
for their rounding, so they only ever prune what is certain; distances themselves are integers.

A round is one pass over the stored parts.  Every task adds up its parts per entry, Spark adds
up the tasks, and the driver sees one row per entry.  Codebooks (256 entries a part) are all
that is broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 6
ROWS = 2048  # vectors looked up together
GROUP = 128  # parts whose remaining entries are evaluated together
SLACK = np.float32(2.0**-19)  # more than the bounds' relative rounding error


# --- looking up ---------------------------------------------------------------------------------


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer arrays."""
    d = a - b
    return (d * d).sum(axis=-1)


def roots(a: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every row to every pivot, as 32-bit floats."""
    d = a[:, None, :].astype(np.float64) - pivots[None].astype(np.float64)
    return np.sqrt((d * d).sum(axis=-1)).astype(np.float32)


def lower_bounds(to_pivots: np.ndarray, entry_pivots: np.ndarray) -> np.ndarray:
    """A distance that no part is nearer to an entry than, for all parts and entries."""
    bound = np.zeros((len(to_pivots), len(entry_pivots)), np.float32)
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - entry_pivots[None, :, p]), out=bound)
    room = SLACK * (to_pivots.max(axis=1)[:, None] + entry_pivots.max(axis=1)[None]) if to_pivots.shape[1] else 0
    return np.maximum(bound - room, 0)


def nearest(parts: np.ndarray, entries: np.ndarray, to_pivots: np.ndarray, entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index of the nearest entry, squared distance, evaluations); ties go to the lower index."""
    n = len(parts)
    rows = np.arange(n)
    bound = lower_bounds(to_pivots, entry_pivots)
    # The entry with the lowest bound comes first; its distance rules out all entries with a larger bound.
    index = bound.argmin(axis=1)
    best = squared(parts, entries[index])
    reach = np.nextafter(np.sqrt(best.astype(np.float64)).astype(np.float32), np.float32(np.inf))
    left = bound <= reach[:, None]
    # What is left is evaluated for groups of parts that begin with the same entry, and so have like bounds.
    order = np.argsort(index, kind="stable")
    evaluated = n
    for lo in range(0, n, GROUP):
        some = order[lo : lo + GROUP]
        columns = np.flatnonzero(left[some].any(axis=0))
        exact = distances(parts[some], entries[columns])
        at = exact.argmin(axis=1)  # columns ascend, so the first of equal ones has the lowest index
        best[some], index[some] = exact[rows[: len(some)], at], columns[at]
        evaluated += exact.size
    return index, best, evaluated


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all parts to all entries, by a matrix product where a double holds its integers."""
    largest = max(np.abs(parts).max(), np.abs(entries).max())
    if 4.0 * parts.shape[1] * float(largest) ** 2 >= 2.0**53:
        return squared(parts[:, None, :], entries[None])
    x, e = parts.astype(np.float64), entries.astype(np.float64)
    return np.rint((x * x).sum(axis=1)[:, None] + (e * e).sum(axis=1) - 2 * (x @ e.T)).astype(np.int64)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0]
    far = squared(entries, entries[0])
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(entries, entries[chosen[-1]]))
    return entries[chosen]


# --- the job ------------------------------------------------------------------------------------


def _clean(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v``: rows whose vector is not null, not empty, and has finite components only."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0)).where(F.coalesce(fine, F.lit(False)))


def _empty(spark, vectors: DataFrame, id_col: str, label_col: str) -> DataFrame:
    kinds = T.StructType([T.StructField("vec_id", vectors.schema[id_col].dataType), T.StructField("label", vectors.schema[label_col].dataType)])
    nothing = spark.createDataFrame([], kinds)
    return nothing.select("*", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))


def quantise(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, label, code, error, codebooks_sha256`` of every kept vector.

    Vectors that are null or hold null, NaN or infinite components are dropped, and so are empty
    ones and those whose length is not that of the vector with the smallest id, or can't be cut
    into ``parts`` equal parts.  Components become ``floor(scale * x)``.  A codebook starts as that
    part of the vectors with the smallest ids (null ids last, equal ids by vector); with fewer
    vectors it has fewer entries.  Components whose squared differences could pass 62 bits (beyond
    some 260,000 at parts of 16) are an error: distances could not be exact.  An empty table gives
    no rows; other columns are not read; rows that repeat are coded alike.
    """
    spark = vectors.sparkSession
    clean = _clean(vectors, id_col, vector_col, label_col)
    seed_order = [F.col("vec_id").isNull(), "vec_id", "v"]
    head = clean.orderBy(*seed_order).select(F.size("v")).first()
    length = head[0] if head else 0
    if not length or length % parts:
        return _empty(spark, vectors, id_col, label_col)
    clean = clean.where(F.size("v") == length)
    width = length // parts
    largest = clean.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    if width * (2 * (largest * scale + 1)) ** 2 >= 2.0**62:
        raise ValueError(f"components of up to {largest:g} are too large for exact 64-bit distances")
    seeds = np.array([r["v"] for r in clean.orderBy(*seed_order).select("v").limit(entries).collect()])
    seeds = np.floor(seeds * scale).astype(np.int64)
    books = [seeds[:, p * width : (p + 1) * width].copy() for p in range(parts)]
    fixed = [choose_pivots(b, pivots) for b in books]

    def prepare(batches):
        """Integers and the distances to the pivots, worked out once."""
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), length)
            x = np.floor(values * scale).astype("<i4")
            near = np.concatenate([roots(x[:, p * width : (p + 1) * width], fixed[p]) for p in range(parts)], axis=1)
            blobs = [pa.array([row.tobytes() for row in rows], pa.binary()) for rows in (x, near)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), *blobs], ["vec_id", "label", "x", "near"])

    kinds = ", ".join(f"{c} {clean.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    path = scratch_path(spark, "vector-parts")
    clean.mapInArrow(prepare, f"{kinds}, x binary, near binary").write.parquet(path)
    stored = spark.read.parquet(path)

    def lookup(batch, books, entry_near):
        """(integers, indexes, squared distances) of all parts of a batch."""
        x, near = (np.frombuffer(b"".join(b.as_py() for b in batch.column(c)), t).reshape(len(batch), -1) for c, t in (("x", "<i4"), ("near", "<f4")))
        x, near = x.astype(np.int64), near.reshape(len(batch), parts, -1)
        found = [nearest(x[:, p * width : (p + 1) * width], books[p], near[:, p], entry_near[p]) for p in range(parts)]
        return x, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def shared(books):
        return spark.sparkContext.broadcast((books, [roots(b, f) for b, f in zip(books, fixed, strict=True)]))

    for _ in range(rounds):
        given = shared(books)

        def add(batches, given=given):
            """A task's counts and sums per part position and entry."""
            sums, counts = np.zeros((parts, entries * width), np.int64), np.zeros((parts, entries), np.int64)
            for batch in batches:
                for lo in range(0, len(batch), ROWS):
                    x, index, _ = lookup(batch.slice(lo, ROWS), *given.value)
                    for p in range(parts):
                        cell = index[:, p, None] * width + np.arange(width)
                        # sums of so few rows are exact in a double
                        sums[p] += np.bincount(cell.ravel(), x[:, p * width : (p + 1) * width].ravel(), entries * width).astype(np.int64)
                        counts[p] += np.bincount(index[:, p], minlength=entries)
            p, e = np.nonzero(counts)
            rows = sums.reshape(parts, entries, width)[p, e].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), pa.array(rows, pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

        stats = stored.select("x", "near").mapInArrow(add, "part int, entry int, n long, sums array<long>")
        total = [F.sum(F.col("sums")[i].cast("decimal(28,0)")) for i in range(width)]
        for part, entry, n, *sums in stats.groupBy("part", "entry").agg(F.sum("n"), *total).collect():  # a row per entry
            books[part][entry] = [int(s) // n for s in sums]

    digest = hashlib.sha256(",".join(str(c) for b in books for entry in b.tolist() for c in entry).encode()).hexdigest()
    given = shared(books)

    def code(batches):
        for batch in batches:
            for lo in range(0, len(batch), ROWS):
                part = batch.slice(lo, ROWS)
                _, index, best = lookup(part, *given.value)
                codes = [bytes(r).hex() for r in index.astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), pa.array(codes, pa.string()), pa.array(best.sum(axis=1))], ["vec_id", "label", "code", "error"])

    return stored.mapInArrow(code, f"{kinds}, code string, error long").withColumn("codebooks_sha256", F.lit(digest))


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``, the error summed over the rows of equal labels (null labels are one label)."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
