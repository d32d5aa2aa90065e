"""Best-fit packing by a grouping genetic algorithm on islands.

Pieces shorter than a sequence are dealt at random into blocks of a few thousand.
For every block several islands evolve packings of the same pieces: crossover
injects whole well-filled bins of one parent into another, bins that would then
hold a piece twice are dissolved, and the displaced pieces go back by best fit.
After every epoch each island sends its best packing to the next one.  A block's
best packing wins.  Bins left half empty are opened again and packed in a second
round over all blocks, so blocks cost next to nothing.

Islands are rows of a table: Spark spreads them, shuffles the elites, and writes
the state after each epoch, so a lost executor costs one epoch of some islands.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.session import scratch_path

BLOCK = 4096


# --- tokens -------------------------------------------------------------------------------------

_encoders: dict[str, object] = {}
LONG_RUN = 100_000  # the ranks' encoder backtracks over a run of white space and fails within a million


def _has_long_run(text: str) -> bool:
    return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in re.finditer(r"\s+", text))


def encoder(path: str):
    """``text -> ids`` for a tokenizer file: ``.tiktoken`` ranks, or any file of the tokenizers library.

    With ranks, a text with ``LONG_RUN`` white-space characters in a row goes through the ``.json`` file
    of the same name, which gives the same ids for runs of any length.
    """
    if path not in _encoders:
        if path.endswith(".tiktoken"):
            import base64

            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            end = {"<|endoftext|>": len(ranks)}
            model = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=end)
            (name,) = end

            def encode(text, model=model, name=name):
                if _has_long_run(text):
                    return encoder(path.removesuffix(".tiktoken") + ".json")(text)
                return model.encode(text, allowed_special="all") if name in text else model.encode_ordinary(text)
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)

            def encode(text, model=model):
                return model.encode(text, add_special_tokens=False).ids

        _encoders[path] = encode
    return _encoders[path]


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, but for the first, which takes what is over."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """``id, piece, start, length, ids`` (little-endian unsigned 32-bit); a null text is empty and has its end id only."""

    def run(batches):
        encode = encoder(tokenizer)
        for batch in batches:
            for lo, hi in textops.slices(batch.column("text")):
                rows, blob = [], []
                for key, text in zip(batch.column("id").slice(lo, hi - lo), batch.column("text").slice(lo, hi - lo).to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end_id], "<u4")
                    blob.append(ids)
                    rows += [(lo, key, no, start, length) for no, (start, length) in enumerate(cut(len(ids), capacity))]
                keys = pa.array([r[1].as_py() for r in rows], batch.schema.field("id").type)
                numbers = np.array([r[2:] for r in rows], np.int64)
                ends = np.concatenate([[0], np.cumsum(numbers[:, 2] * 4)]).astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.concatenate(blob))])
                yield pa.RecordBatch.from_arrays([keys, pa.array(numbers[:, 0].astype(np.int32)), pa.array(numbers[:, 1]), pa.array(numbers[:, 2]), ids],
                                                 ["id", "piece", "start", "length", "ids"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")


# --- the genetic algorithm of one island --------------------------------------------------------


def best_fit(sizes: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the items of ``order`` into the fullest bin that takes them; ``bins`` and ``room`` are changed in place.

    Bins are kept by their room, and one integer has a bit for every room in use: the lowest bit at or
    above a size is the best fit, so an item costs the same however many bins there are.
    """
    by_room: dict[int, list[int]] = {}
    used = 0
    for b, r in enumerate(room):
        if 0 < r:
            by_room.setdefault(r, []).append(b)
            used |= 1 << r
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fits = used >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            stack = by_room[r]
            b = stack.pop()
            if not stack:
                used ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(r)
        r -= size
        room[b] = r
        bins[item] = b
        if r:
            by_room.setdefault(r, []).append(b)
            used |= 1 << r


def compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def cost(sizes: np.ndarray, bins: np.ndarray) -> tuple[int, int]:
    """Fewer bins first, then fuller ones."""
    fill = np.bincount(bins, sizes).astype(np.int64)
    return len(fill), -int((fill * fill).sum())


def crossover(sizes, giver, taker, capacity, rng) -> np.ndarray:
    """Whole well-filled bins of ``giver`` enter ``taker``; what they displace goes back by best fit."""
    fill = np.bincount(giver, sizes)
    chosen = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < rng.uniform(0.1, 0.6))
    injected = chosen[giver]
    broken = np.zeros(taker.max() + 1, bool)
    broken[taker[injected]] = True
    broken |= (np.bincount(taker, sizes) < capacity) & (rng.random(len(broken)) < 0.5)  # mutation: open part of the unfilled bins
    displaced = np.flatnonzero(broken[taker] & ~injected)
    child = taker + len(fill)
    child[injected] = giver[injected]
    child[displaced] = -1
    placed = child >= 0
    child[placed] = compact(child[placed])
    room = (capacity - np.bincount(child[placed], sizes[placed])).astype(int).tolist()
    noise = rng.uniform(0.9, 1.1, len(displaced)) if rng.random() < 0.5 else 1.0
    best_fit(sizes, displaced[np.argsort(-sizes[displaced] * noise, kind="stable")], child, room, capacity)
    return compact(child)


def evolve(sizes: np.ndarray, population: list[np.ndarray], capacity: int, size: int, children: int, rng) -> list[np.ndarray]:
    """One epoch: seed the island if it is new, then steady-state breeding; best packing first.

    Stops early at the lower bound of ``ceil(sum / capacity)`` bins, which nothing can beat.
    """
    least = -(-int(sizes.sum()) // capacity)
    while len(population) < size:
        noise = rng.uniform(0.8, 1.2, len(sizes)) if population else 1.0
        bins = np.full(len(sizes), -1, np.int32)
        best_fit(sizes, np.argsort(-sizes * noise, kind="stable"), bins, [], capacity)
        population.append(compact(bins))
    ranked = sorted(((cost(sizes, p), i, p) for i, p in enumerate(population)), key=lambda x: x[:2])
    for k in range(children):
        if ranked[0][0][0] <= least:
            break
        a, b = rng.choice(len(ranked), 2, replace=False)
        child = crossover(sizes, ranked[min(a, b)][2], ranked[max(a, b)][2], capacity, rng)
        made = (cost(sizes, child), len(population) + k, child)
        if made[0] < ranked[-1][0]:
            ranked = sorted([*ranked[:-1], made], key=lambda x: x[:2])
    return [p for _, _, p in ranked[:size]]


# --- islands on Spark ---------------------------------------------------------------------------

_ISLAND = "block long, island int, uids array<long>, sizes array<int>, population array<array<int>>"


def _epoch(state: DataFrame, capacity: int, size: int, children: int, epoch: int) -> DataFrame:
    def run(frames):
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                rng = np.random.default_rng([int(row.block), int(row.island), epoch])
                sizes = np.asarray(row.sizes, np.int64)
                population = [np.array(p, np.int32) for p in row.population]
                best = evolve(sizes, population, capacity, size, children, rng)
                out.append((row.block, row.island, row.uids, row.sizes, [p.tolist() for p in best]))
            yield pd.DataFrame(out, columns=["block", "island", "uids", "sizes", "population"])

    return state.mapInPandas(run, _ISLAND)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pack_round(items: DataFrame, n_items: int, capacity: int, round_no: int, islands: int, size: int, children: int, epochs: int) -> DataFrame:
    """``uid, size`` -> ``uid, sequence_id, offset, filled`` for one round over all blocks."""
    blocks = max(1, round(n_items / BLOCK))
    # Rows are few and small but each is much work: so many tasks, whatever their bytes.
    tasks = max(items.sparkSession.sparkContext.defaultParallelism, blocks * islands // 64)
    dealt = items.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(blocks)))
    state = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("size", "uid")), asc=False).alias("x")).select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("x.uid").alias("uids"), F.col("x.size").alias("sizes"),
        F.array().cast("array<array<int>>").alias("population"),
    )
    for epoch in range(epochs):
        if epoch:  # the best packing of each island also joins the next island of its block
            migrants = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.slice("population", 1, 1).alias("migrant"))
            state = state.join(migrants, ["block", "island"]).withColumn("population", F.concat("migrant", "population")).drop("migrant")
        state = _written(_epoch(state.repartition(tasks, "block", "island"), capacity, size, children, epoch), "packing-islands")
    n = F.array_max(F.element_at("population", 1)) + 1
    best = state.groupBy("block").agg(F.min(F.struct(n.alias("n"), "island")).alias("b")).select("block", F.col("b.island").alias("island"))

    def spread(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                sizes, bins = np.asarray(row.sizes, np.int64), np.asarray(row.population[0], np.int64)
                order = np.argsort(bins, kind="stable")
                run, fill = np.cumsum(sizes[order]) - sizes[order], np.bincount(bins, sizes).astype(np.int64)
                offset = np.empty(len(bins), np.int64)
                offset[order] = run - (np.cumsum(fill) - fill)[bins[order]]
                sequence = (np.int64(round_no) << 56) + (np.int64(row.block) << 16) + bins
                yield pd.DataFrame({"uid": np.asarray(row.uids), "sequence_id": sequence, "offset": offset, "filled": fill[bins]})

    return state.join(best, ["block", "island"]).mapInPandas(spread, "uid long, sequence_id long, offset long, filled long")


def assign_sequences(items: DataFrame, capacity: int, islands: int = 3, size: int = 4, children: int = 12, epochs: int = 2, reopen: float = 0.97) -> DataFrame:
    """``uid`` (unique long), ``size`` (1 to capacity) -> ``uid, sequence_id, offset``; offsets are gapless from 0."""
    items = items.select("uid", F.col("size").cast("int").alias("size"))
    full = items.where(F.col("size") == capacity).select("uid", (F.lit(1 << 60) + F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("size") < capacity)
    options = {"islands": islands, "size": size, "children": children, "epochs": epochs}
    first = _written(_pack_round(rest, rest.count(), capacity, 1, **options), "packing-round")
    loose = F.col("filled") < reopen * capacity
    again = _written(rest.join(first.where(loose).select("uid"), "uid", "left_semi"), "packing-loose")
    second = _pack_round(again, again.count(), capacity, 2, **options)
    return full.unionByName(first.where(~loose).drop("filled")).unionByName(second.drop("filled"))


def pack_documents(docs: DataFrame, tokenizer: str, carry: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 1024, end_id: int = 2, **options) -> DataFrame:
    """Packed pieces: ``id, piece, start, length``, the ``carry`` columns, ``sequence_id, offset``.

    ``carry`` maps names to expressions over a piece's columns; by default it is the token ids
    themselves (``ids``).  Every row of ``docs`` is packed for itself, repeated rows and null ids
    too; an empty or null text is one end id.  An empty table gives no rows; columns other than id
    and text are not read.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    made = token_pieces(docs, tokenizer, id_col, text_col, capacity, end_id)
    pieces = _written(made.select("id", "piece", "start", "length", *(c.alias(n) for n, c in carry.items()), F.monotonically_increasing_id().alias("_uid")), "packing-pieces")
    places = assign_sequences(pieces.select(F.col("_uid").alias("uid"), F.col("length").alias("size")), capacity, **options)
    return pieces.join(places, F.col("_uid") == F.col("uid")).drop("_uid", "uid")
