"""Quality rules with host verdicts.

Each document is measured over its whole text; the base rules fail it or not.
Failures are then added up per host (the document's source), each host's failure
rate is shrunk by a beta prior fitted to all hosts, and hosts whose shrunk rate
is too high are rejected together with all their documents.

Measuring works on whole Arrow batches with numpy, batches cut to about a
megabyte of text, so memory follows the longest text, not the partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.session import scratch_path

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
HOST_LIMIT = 0.5  # shrunk failure rate above which a host is rejected
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeats(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For values of texts: (in a group of two or more equal values of a text, and not the first of its group)."""
    order = np.lexsort((values, text))  # stable: equal values stay in their order
    same = np.zeros(len(values), bool)
    same[1:] = (values[order][1:] == values[order][:-1]) & (text[order][1:] == text[order][:-1])
    member = same.copy()
    member[:-1] |= same[1:]
    out, later = np.zeros(len(values), bool), np.zeros(len(values), bool)
    out[order], later[order] = member, same
    return out, later


def measure_texts(column) -> dict[str, np.ndarray]:
    """The five measures of every text of a column."""
    data, offsets = textops.text_bytes(column)
    starts, ends, bounds = textops.word_spans(data, offsets)
    n_words = np.diff(bounds)
    word_chars = _per_text(~textops.SPACE[data] & ((data & 0xC0) != 0x80), offsets)

    # Lines end at \n or at the end of a text; only lines with a word count.
    ids = np.arange(len(n_words))
    breaks = np.flatnonzero(data == 10)
    line_text = np.concatenate([np.searchsorted(offsets, breaks, "right") - 1, ids])
    line_end = np.concatenate([breaks, offsets[1:]])
    order = np.lexsort((line_end, line_text))
    line_text, line_end = line_text[order], line_end[order]
    line_start = np.empty_like(line_end)
    first = np.searchsorted(line_text, ids)
    line_start[1:] = line_end[:-1] + 1
    line_start[first] = offsets[:-1]
    with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_text, line_start, line_end = line_text[with_word], line_start[with_word], line_end[with_word]
    _, dup = _repeats(textops.span_hashes(data, line_start, line_end), line_text)
    n_dup = np.bincount(line_text[dup], minlength=len(n_words))

    words = textops.span_hashes(data, starts, ends)
    head, before = textops.window_index(bounds, 3)
    text_of = np.repeat(ids, np.diff(before))
    twice, _ = _repeats(textops.window_hashes(words, head, 3), text_of)
    covered = np.zeros(len(words), bool)
    for j in range(3):
        covered[head[twice] + j] = True
    return dict(zip(METRICS, (n_words, word_chars, _per_text(SYMBOLS[data], offsets), n_dup, _per_text(covered, bounds)), strict=True))


def measure(docs: DataFrame, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``doc`` (the other columns), the measures as longs, and the text if asked for; null text has no words."""
    carry = [c for c in docs.columns if c != text_col]
    doc = F.struct(*(F.col(f"`{c}`") for c in carry)) if carry else F.struct(F.lit(0).alias("_"))
    packed = docs.select(doc.alias("doc"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for lo, hi in textops.slices(batch.column("text")):
                part = batch.slice(lo, hi - lo)
                got = measure_texts(part.column("text"))
                columns = [part.column("doc"), *(pa.array(got[m].astype(np.int64)) for m in METRICS)]
                yield pa.RecordBatch.from_arrays(columns + [part.column("text")] * with_text, ["doc", *METRICS] + ["text"] * with_text)

    schema = f"doc {packed.schema['doc'].dataType.simpleString()}, " + ", ".join(f"{m} long" for m in METRICS) + ", text string" * with_text
    return packed.mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def beta_prior(hosts: int, documents: int, failed: int, spread: float) -> tuple[float, float]:
    """Alpha and beta by moments: ``spread`` is the document-weighted sum of squares of host rates around the mean.

    What binomial noise alone would give is taken off the variance; the prior's weight stays between
    one and a million documents, which also covers no documents, one host and hosts that are all alike.
    """
    if not documents:
        return 0.5, 0.5
    mean = failed / documents
    noise = mean * (1 - mean)
    between = spread / documents - noise * hosts / documents
    weight = min(max(noise / between - 1, 1.0), 1e6) if between > 0 else 1e6
    return mean * weight, (1 - mean) * weight


def host_verdicts(failures: DataFrame, limit: float) -> DataFrame:
    """``host, n, failed, rate, rejected`` from ``host, failed`` per document."""
    hosts = failures.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("failed"))
    path = scratch_path(failures.sparkSession, "host-rules")
    hosts.write.parquet(path)
    hosts = failures.sparkSession.read.parquet(path)
    n_hosts, n, failed = hosts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("failed"), F.lit(0))).first()
    mean = failed / n if n else 0.0
    spread = hosts.agg(F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - mean, F.lit(2.0)))).first()[0]
    alpha, beta = beta_prior(n_hosts, n, failed, spread or 0.0)
    rate = (F.col("failed") + alpha) / (F.col("n") + alpha + beta)
    return hosts.select("host", "n", "failed", rate.alias("rate"), (rate > limit).alias("rejected"))


def judge(measured: DataFrame, host_col: str = "source", limit: float = HOST_LIMIT, verdicts: DataFrame | None = None) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``; hosts are read from ``doc.<host_col>``.

    ``verdicts`` are worked out from ``measured`` unless given.  A null host is a host of its own.  A document is kept if it passes the base rules and its host is
    not rejected.  Repeated rows count as often as they stand there; an empty table gives no rows.
    """
    measured = measured.withColumn("base_failed", base_failed())
    if verdicts is None:
        verdicts = host_verdicts(measured.select(F.col(f"doc.`{host_col}`").alias("host"), F.col("base_failed").alias("failed")), limit)
    bad = verdicts.where("rejected").select(F.col("host").alias("bad_host"), "rejected")
    joined = measured.join(bad, F.col(f"doc.`{host_col}`").eqNullSafe(F.col("bad_host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("rejected").isNull()).drop("bad_host", "rejected")
