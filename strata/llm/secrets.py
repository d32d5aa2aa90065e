"""Secret scanner: pattern spans plus a randomness test battery.

Spans are found with built-in expressions only.  ``regexp_extract_all`` does not
report positions, so each pattern is anchored at the end of the previous match
and also captures the gap before it: ``\\G(gap lazily)(match)``.  The lengths of
gaps and matches, added up, are the positions, in code points.

The battery looks at long runs of token characters.  It infers the encoding of a
run (hex, base32, base64), and tests the run for what a key drawn at random
shows: uniform use of the alphabet (chi-squared), as many runs above and below
the alphabet's middle as independent draws give, and no serial correlation.  Each
test gives a tail probability; the three are combined.  A false-discovery rule
(Benjamini-Hochberg), applied within length bands of each encoding, then decides
which runs are certainly not random.  The others are reported as ``random``.

All statistics of the rule are counts per (encoding, length band, probability
step): a table of fixed size, whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import scratch_path

# Fixed patterns: kind -> (pattern, group whose length counts, least length).  A run of one class is matched
# whole or not at all, so its least length stands in the pattern; an assignment consumes its match even if it is short.
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
KINDS = (*PATTERNS, "random")
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Fixed alphabets of the encodings, in the order in which they are inferred.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
STEPS = 200  # probability steps of the false-discovery histogram: exp(-step / 10)
BANDS = 16  # length bands: one per doubling of the length


def _found(text: Column, pattern: str, counted: int = 0) -> Column:
    """``(start, end, counted, token)`` of each match; ``counted`` is the group whose length matters."""
    # The lazy gap makes every match the leftmost one after the last; \\G keeps a failed tail from being tried again.
    anchored = F.lit(rf"\G((?s:.*?))({pattern})")
    gaps, found = (F.regexp_extract_all(text, anchored, F.lit(g)) for g in (1, 2))
    inner = F.regexp_extract_all(text, anchored, F.lit(3)) if counted else found
    parts = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("token"))), inner,
                       lambda p, c: F.struct(p["gap"].alias("gap"), p["token"].alias("token"), F.length(c).alias("counted")))
    kind = "array<struct<start:int,end:int,counted:int,token:string>>"
    none = F.array().cast(kind)

    def add(acc, part):
        begin = acc["at"] + part["gap"]
        end = begin + F.length(part["token"])
        one = F.struct(begin.alias("start"), end.alias("end"), part["counted"].alias("counted"), part["token"].alias("token"))
        return F.struct(end.alias("at"), F.concat(acc["all"], F.array(one)).alias("all"))

    def add_block(acc, block):
        inner = F.aggregate(block, F.struct(acc["at"].alias("at"), none.alias("all")), add)
        return F.struct(inner["at"].alias("at"), F.concat(acc["all"], F.array(inner["all"])).alias("all"))

    def all_spans(parts):
        """Blocks of the root of the count: no array is appended to more often than that."""
        size = F.ceil(F.sqrt(F.size(parts).cast("double"))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), size - 1), lambda b: F.slice(parts, b * size + 1, size))
        folded = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("all")), lambda acc, b: _let(F.struct(acc.alias("acc"), b.alias("b")), lambda x: add_block(x["acc"], x["b"])))
        return F.flatten(folded["all"])

    return F.when(text.rlike(pattern), _let(parts, all_spans)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Pattern spans ``(start, kind_no, end)`` by start, then kind."""
    def spans_of(no, pattern, counted, least):
        long_enough = F.filter(_found(text, pattern, counted), lambda m: m["counted"] >= least)
        return F.transform(long_enough, lambda m: F.struct(m["start"].alias("start"), F.lit(no).alias("kind_no"), m["end"].alias("end")))

    return F.array_sort(F.concat(*(spans_of(no, *rule) for no, rule in enumerate(PATTERNS.values()))))


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, by its logistic approximation."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _let(value: Column, use) -> Column:
    """Bind an expression to a lambda variable, so it is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _encoding(token: Column) -> Column:
    """Number of the inferred encoding (from 1), 0 if the run has none: letters alone infer nothing."""
    digit = token.rlike("[0-9]")
    return (
        F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$") & digit & token.rlike("[a-fA-F]"), 1)
        .when(token.rlike("^[A-Z2-7]+$") & digit, 2)
        .when(digit & token.rlike("[a-z]") & token.rlike("[A-Z]"), 3)
        .otherwise(0)
    )


def battery(token: Column, encoding: Column) -> Column:
    """Combined tail probability (Fisher) of the three tests that the run is random; small: it is not."""
    letters = F.when(encoding == 1, ALPHABETS["hex"]).when(encoding == 2, ALPHABETS["base32"]).otherwise(ALPHABETS["base64"])
    plain = F.when(encoding == 1, F.lower(token)).otherwise(F.translate(token, "-_", "+/"))
    codes = F.transform(F.split(plain, ""), lambda c: F.instr(letters, c).cast("double") - 1)

    def tests(x):
        n, a = F.size(x).cast("double"), F.length(letters).cast("double")
        squares = F.aggregate(F.sequence(F.lit(0), F.length(letters) - 1), F.lit(0.0), lambda acc, k: acc + F.pow(F.size(F.filter(x, lambda c: c == k)).cast("double"), F.lit(2.0)))
        chi = a / n * squares - n
        h = 2 / (9 * (a - 1))
        z_chi = (F.cbrt(chi / (a - 1)) - (1 - h)) / F.sqrt(h)

        high = F.size(F.filter(x, lambda c: c >= a / 2)).cast("double")
        pairs = F.zip_with(F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1), lambda u, v: F.struct(u.alias("u"), v.alias("v")))
        runs = 1 + F.size(F.filter(pairs, lambda p: (p["u"] >= a / 2) != (p["v"] >= a / 2)))
        mu = 2 * high * (n - high) / n + 1
        var = (mu - 1) * (mu - 2) / (n - 1)
        z_runs = F.when(var > 0, F.abs(runs - mu) / F.sqrt(var)).otherwise(F.lit(6.0))

        mean = F.aggregate(x, F.lit(0.0), lambda acc, c: acc + c) / n

        def correlation(m):
            spread = F.aggregate(x, F.lit(0.0), lambda acc, c: acc + (c - m) * (c - m))
            joint = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["u"] - m) * (p["v"] - m))
            return F.when(spread > 0, F.abs(joint / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(6.0))

        logs = [F.log(F.greatest(p, F.lit(1e-12))) for p in (_tail(z_chi), 2 * _tail(z_runs), 2 * _tail(_let(mean, correlation)))]
        half = -(logs[0] + logs[1] + logs[2])
        return _let(half, lambda y: F.exp(-y) * (1 + y + y * y / 2))

    return _let(codes, tests)


def candidates(text: Column) -> Column:
    """Runs with an inferred encoding: ``(start, end, encoding, band, step)``."""

    def measure(m):
        bare = F.regexp_replace(m["token"], "=+$", "")
        enc = _encoding(bare)
        step = F.least(F.floor(-10 * F.log(F.greatest(battery(bare, enc), F.lit(1e-12)))), F.lit(STEPS - 1)).cast("int")
        band = F.least(F.floor(F.log2(F.length(bare).cast("double"))), F.lit(BANDS - 1)).cast("int")
        return F.struct(m["start"].alias("start"), m["end"].alias("end"), enc.alias("encoding"), band.alias("band"), F.when(enc > 0, step).alias("step"))

    return F.filter(F.transform(_found(text, CANDIDATE), measure), lambda c: c["encoding"] > 0)


def rejection_steps(counts: dict[tuple[int, int], dict[int, int]], rate: float) -> dict[tuple[int, int], int]:
    """Per (encoding, band) the first step at which runs are declared not random (Benjamini-Hochberg on the step grid)."""
    out = {}
    for stratum, steps in counts.items():
        total, seen, first = sum(steps.values()), 0, STEPS
        for s in range(STEPS - 1, -1, -1):
            seen += steps.get(s, 0)
            if seen and math.exp(-s / 10) <= rate * seen / total:
                first = s
        out[stratum] = first
    return out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.05) -> DataFrame:
    """One row per document: ``id, spans``, an array of ``(start, kind_no, end)`` by start, then kind.

    Positions are code points, ends exclusive; ``KINDS[kind_no]`` names the kind.  A random run that
    touches a pattern span is not reported again.  Null and empty texts have no spans; rows that
    repeat are scanned each for itself; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    path = scratch_path(spark, "secrets")
    docs.select(F.col(id_col).alias("id"), text.alias("text")).select("id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("runs")).write.parquet(path)
    found = spark.read.parquet(path)

    histogram = found.select(F.explode("runs").alias("r")).groupBy("r.encoding", "r.band", "r.step").count()
    counts: dict[tuple[int, int], dict[int, int]] = {}
    for encoding, band, step, n in histogram.collect():  # at most encodings x bands x steps rows
        counts.setdefault((encoding, band), {})[step] = n
    limits = F.create_map(*(x for (e, b), first in rejection_steps(counts, rate).items() for x in (F.lit(e * BANDS + b), F.lit(first)))) if counts else None

    def random_run(r):
        passes = r["step"] < F.element_at(limits, r["encoding"] * BANDS + r["band"])
        return passes & ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"]))

    spans = F.col("base")
    if limits is not None:
        extra = F.transform(F.filter("runs", random_run), lambda r: F.struct(r["start"].alias("start"), F.lit(KINDS.index("random")).alias("kind_no"), r["end"].alias("end")))
        spans = F.array_sort(F.concat("base", extra))
    return found.select("id", spans.alias("spans"))


def count_kind(spans: Column, kind: str) -> Column:
    no = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind_no"] == no)).cast("long")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
