"""Quality rules, line dedup, packing, WARC, the Jaccard join and PPM against brute force, with odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard_join, line_dedup, packing, ppm, quality_rules, textops, warc
from strata.llm.components import components
from strata.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, id string, key string, pos string, line string, doc string, n string, token string, kept string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, *["x"] * 8) for i, t, s in rows], SCHEMA)


ODD_TEXTS = [None, "", " \n\t", "one", "a b c a b c\n\nx\nx \nx\né ü ab\x0bcd", "w " * 3000, " wide space ", "x" * 20_000, "A\r\nB\r\nA\r\n", "\U0001f600 # $ \U0001f600"]


# --- text primitives and quality rules


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def brute_measures(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) for j in range(3) if windows[tuple(words[i : i + 3])] > 1}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)]


def brute_shingles(text, k=5):
    words = WORD.findall(lower(text))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def test_measures_and_shingles():
    rnd = random.Random(1)
    texts = ODD_TEXTS + ["".join(rnd.choice("ab \n\t#é") for _ in range(rnd.randint(0, 90))) for _ in range(300)]
    got = quality_rules.measure_texts(pa.array(texts))
    assert [[int(got[m][i]) for m in quality_rules.METRICS] for i in range(len(texts))] == [brute_measures(t) for t in texts]
    hashes, bounds = textops.shingles(*textops.text_bytes(pa.array(texts)))
    sets, want = [hashes[a:b] for a, b in itertools.pairwise(bounds)], [brute_shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in want]
    for i, j in itertools.combinations(range(0, len(texts), 5), 2):
        assert len(np.intersect1d(sets[i], sets[j])) == len(want[i] & want[j])
    assert [r for lo, hi in textops.slices(pa.array(texts), 100) for r in range(lo, hi)] == list(range(len(texts)))


def test_host_verdicts(spark):
    rnd = random.Random(2)
    good = lambda: " ".join(f"w{rnd.randint(0, 10**6)}" for _ in range(60))
    rows = [(i, good() if rnd.random() < rate else "bad", host) for i, (host, rate) in enumerate([("good", 0.95)] * 80 + [("bad", 0.1)] * 60 + [(None, 0.05)] * 40 + [("tiny", 0.0)])]
    rows += [(1000 + i, t, "odd") for i, t in enumerate(ODD_TEXTS)] + [(7, good(), "good")] * 3
    got = quality_rules.judge(quality_rules.measure(docs_of(spark, rows))).select("doc.doc_id", "doc.source", "base_failed", "kept", *quality_rules.METRICS).collect()
    measures = [(i, s, brute_measures(t)) for i, t, s in rows]
    failed = [(i, s, m, m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, s, m in measures]
    per = defaultdict(list)
    for _, s, _, f in failed:
        per[s].append(f)
    n, mean = len(rows), sum(f for *_, f in failed) / len(rows)
    spread = sum(len(v) * (sum(v) / len(v) - mean) ** 2 for v in per.values())
    between = spread / n - mean * (1 - mean) * len(per) / n
    weight = min(max(mean * (1 - mean) / between - 1, 1), 1e6) if between > 0 else 1e6
    rejected = {s for s, v in per.items() if (sum(v) + mean * weight) / (len(v) + weight) > 0.5}
    assert {"bad", None} <= rejected and "good" not in rejected
    want = sorted((i, str(s), f, not f and s not in rejected, *m) for i, s, m, f in failed)
    assert sorted((r[0], str(r[1]), *r[2:]) for r in got) == want
    assert quality_rules.judge(quality_rules.measure(docs_of(spark, []))).count() == 0


# --- line dedup


def brute_lines(rows, min_sites, min_words):
    sites, first = defaultdict(set), {}
    for i, t, s in rows:
        for pos, raw in enumerate(t.split("\n") if t is not None else []):
            line = raw.strip(" \t\r")
            if len(WORD.findall(line)) >= min_words:
                sites[line].add(s)
                place = (i is None, i or 0, pos)
                first[line] = min(first.get(line, place), place)
    out = []
    for i, t, _ in rows:
        parts = t.split("\n") if t is not None else []
        gone = {p for p, raw in enumerate(parts) if len(sites[raw.strip(" \t\r")]) >= min_sites and first[raw.strip(" \t\r")] != (i is None, i or 0, p)}
        out.append((i, None if t is None else "\n".join(x for p, x in enumerate(parts) if p not in gone), len(parts), len(gone)))
    return out


@pytest.mark.parametrize("band", [1, 2, 9])
def test_line_dedup(spark, band):
    rnd = random.Random(3)
    pool = [f"line {k} of the pool" for k in range(40)]
    rows = [(i, "\n".join(rnd.choice(pool + [f"own line {i} {j}", "", "two words", f" {pool[0]}\t\r"]) for j in range(rnd.randint(0, 8))), rnd.choice("abcdefgh") if i % 9 else None) for i in range(60)]
    rows += [(100 + i, t, "a") for i, t in enumerate(ODD_TEXTS)] + [(200, "all of it\nall of it\nall of it", s) for s in "abcdef"]
    got = line_dedup.dedup_lines(docs_of(spark, rows), band=band).select("doc.doc_id", "doc.text", "n_lines", "n_removed").collect()
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = brute_lines(rows, 6, 1)
    assert any(r[3] for r in want)
    # rows that repeat an id at several sites hold the first place once
    first = [r for r in want if r[0] == 200]
    assert sorted(map(tuple, (r for r in got if r[0] != 200)), key=key) == sorted((r for r in want if r[0] != 200), key=key)
    kept = [r for r in got if r["doc_id"] == 200]
    assert sorted(r["n_removed"] for r in kept) == [2, 3, 3, 3, 3, 3] and len(first) == 6
    assert line_dedup.dedup_lines(docs_of(spark, [])).count() == 0


def test_null_id_and_repeats_in_line_dedup(spark):
    rows = [(None, "one two three", s) for s in "abcdefg"] + [(5, "one two three\nrest", "a")] * 2
    got = sorted((str(r[0]), r[1]) for r in line_dedup.dedup_lines(docs_of(spark, rows)).select("doc.doc_id", "doc.text").collect())
    assert got == [("5", "one two three\nrest")] * 2 + [("None", "")] * 7


# --- packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_encoders_agree():
    fast, slow = packing.encoder(RANKS), packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(4)
    chars = [chr(c) for c in [*range(0x20, 0x500), *range(0x4E00, 0x4E40), *range(0x1F600, 0x1F620)]] + list(" \n\t'") * 60
    for text in ["", "<|endoftext|>", "a <|endoftext|> b", "a" * 50_000, " " * 5_000, *("".join(rnd.choices(chars, k=rnd.randint(1, 200))) for _ in range(500))]:
        assert fast(text) == slow(text)


def test_encoders_agree_on_long_runs(spark, monkeypatch):
    fast, slow = packing.encoder(RANKS), packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    n = 2_000_000
    texts = ["a" + " " * n + "b <|endoftext|>", "\n" * n, " " * (packing.LONG_RUN - 1) + "x"]
    want = [slow(t) for t in texts]
    assert [fast(t) for t in texts] == want
    pieces = packing.token_pieces(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)]), RANKS, capacity=1 << 30).select("id", "ids").collect()
    assert {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in pieces} == {i: [*ids, 2] for i, ids in enumerate(want)}
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    rnd = random.Random(6)
    for _ in range(300):
        text = "".join(rnd.choices(list("ab1. \n\t\u3000\x85\x1c"), k=60))
        assert fast(text) == slow(text)


def test_genetic_algorithm_keeps_items_and_improves():
    rng = np.random.default_rng(0)
    sizes = rng.choice([300, 340, 350, 400, 500, 520, 640, 700], 500)
    alone = packing.evolve(sizes, [], 1024, 4, 0, rng)
    evolved = packing.evolve(sizes, alone, 1024, 4, 60, rng)
    assert packing.cost(sizes, evolved[0]) <= packing.cost(sizes, alone[0])
    for bins in evolved:
        assert len(bins) == len(sizes) and bins.min() == 0 and np.bincount(bins, sizes).max() <= 1024
    child = packing.crossover(sizes, evolved[0], evolved[1], 1024, rng)
    assert len(child) == len(sizes) and set(child) == set(range(child.max() + 1)) and np.bincount(child, sizes).max() <= 1024


@pytest.mark.parametrize("block", [packing.BLOCK, 16])
def test_packing_round_trip(spark, monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    rnd = random.Random(5)
    rows = [(i, " ".join("abcdefgh"[rnd.randrange(8)] * rnd.randint(1, 3) for _ in range(rnd.choice([0, 3, 30, 100, 300]))), "s") for i in range(120)]
    rows += [(500 + i, t, "s") for i, t in enumerate(ODD_TEXTS)] + [(None, "x y", "s"), (3, "again", "s"), (3, "again", "s")]
    got = packing.pack_documents(docs_of(spark, rows), RANKS, capacity=64).collect()
    encode = packing.encoder(RANKS)
    want = Counter()
    for i, t, _ in rows:
        ids = [*encode(t or ""), 2]
        for no, (start, n) in enumerate(packing.cut(len(ids), 64)):
            want[i, no, start, n, np.array(ids[start : start + n], "<u4").tobytes()] += 1
    assert Counter((r["id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    total = sum(r["length"] for r in got)
    assert len(sequences) <= math.ceil(total / 64) * (1.03 if block > 16 else 1.08) + 1
    assert packing.pack_documents(docs_of(spark, []), RANKS).count() == 0


# --- WARC


def test_monolithic_members_and_cut_streams():
    recs = [warc._record("response", f"urn:page:{i}", "http://x/é\r\nInjected: 1", "d", b"p\r\n\r\n" * i, 5 * i, hashlib.sha1(b"").digest(), None) for i in range(0, 900, 31)]

    class Stream:
        def __init__(self, blob):
            self.blob = blob

        def read(self, n):
            out, self.blob = self.blob[:n], self.blob[n:]
            return out

    def gz(blob):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        return z.compress(blob) + z.flush()

    for blob, want in ((gz(b"".join(recs)), recs), (b"".join(map(gz, recs)), recs), (b"", [])):
        assert [r for _, r in warc.records(warc.inflate(Stream(blob), 50))] == want
    for broken in (gz(b"".join(recs))[:-30], gz(b"".join(recs)[:-30])):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.records(warc.inflate(Stream(broken), 50)))
    assert b"\nInjected" not in recs[0].split(b"\r\n\r\n")[0]


def test_warc_round_trip(spark):
    big = "é" * 600
    rows = [(1, "u1", big), (2, "u2", big), (5, None, big), (3, "u", "s"), (4, "u", "s"), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", "z" * 300_000), (9, "u", "q" * 999), (10, "u", "q" * 999), (11, "u", "r" * 1000), (11, "u", "r" * 1000)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, payload string, id string")
    folder = warc.shared_uri(spark, "warc-test")
    index = warc.archive(pages, folder)
    got = warc.read_indexed(index).collect()
    html = {i: (t or "").encode() for i, _, t in rows}
    assert len(got) == len(rows) == index.count()
    for r in got:
        i = int(r["id"]) if r["id"] else None
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html[i]), hashlib.sha1(html[i]).hexdigest())
        again = i in (1, 2, None)
        assert (r["record_type"], r["refers_to"]) == (("revisit", "5") if again else ("response", None))
        assert r["payload"] is None if again else bytes(r["payload"]) == html[i]
    for path in {r["path"] for r in index.collect()}:
        sidecar = open(path.removeprefix("file://") + ".idx").read().splitlines()
        assert len(sidecar) == index.where(F.col("path") == path).count()
    assert warc.archive(pages.limit(0), warc.shared_uri(spark, "warc-test")).count() == 0


# --- components and the Jaccard join


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rnd = random.Random(6)
    edges = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 340)] + [(5, 5)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert dict(map(tuple, got)) == brute_components(nodes, [e for e in edges if e[0] != e[1]]) and len(got) == len(nodes)


def near_texts(rnd, words, copies, change):
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(words)]
    return [" ".join(w if rnd.random() > change else f"m{rnd.randint(0, 10**6)}" for w in base) for _ in range(copies)]


@pytest.mark.parametrize(("list_max", "block"), [(jaccard_join.LIST_MAX, jaccard_join.HOOD_BLOCK), (3, 4)])
def test_jaccard_components(spark, monkeypatch, list_max, block):
    monkeypatch.setattr(jaccard_join, "PARTNERS", 5)
    monkeypatch.setattr(jaccard_join, "HOOD_BLOCK", block)
    monkeypatch.setattr(jaccard_join, "PROBES", 50 * block)
    rnd = random.Random(7)
    passage = " ".join(f"p{k}" for k in range(40))
    texts = list(ODD_TEXTS)
    for change in (0.0, 0.01, 0.02, 0.03, 0.05, 0.08):
        texts += near_texts(rnd, 90, 12, change) + near_texts(rnd, 30, 6, change)
    texts += [f"{passage} {' '.join(near_texts(rnd, 12, 1, 0))}" for _ in range(25)] + ["Same Words Here", "same words here", "a b c d e", "A B C D E f"]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(9_000, texts[20], "s"), (None, texts[21], "s"), (None, "lonely words", "s"), (3, texts[3], "s")]
    got = jaccard_join.jaccard_components(docs_of(spark, rows), list_max=list_max).collect()
    sets = [brute_shingles(t) for _, t, _ in rows]
    edges = [(a, b) for a, b in itertools.combinations(range(len(rows)), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = brute_components(range(len(rows)), edges)
    low = {}
    for at, c in comp.items():
        if rows[at][0] is not None:
            low[c] = min(low.get(c, 10**9), rows[at][0])
    want = [(rows[at][0], len(sets[at]), low.get(comp[at])) for at in range(len(rows))]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 5, 255, 256, 257, 900, 3000, 3500)] * 2
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    blob, ends = jaccard_join.bitmaps(np.concatenate(sets), bounds)
    maps = [blob[a:b] for a, b in itertools.pairwise(ends)]
    for i, j in itertools.combinations(range(len(sets)), 2):
        differ = len(np.setxor1d(sets[i], sets[j]))
        assert jaccard_join.least_difference(maps[i], maps[j]) <= differ
    assert jaccard_join.least_difference(maps[6], maps[14]) == 0 and jaccard_join.least_difference(maps[5], maps[7]) > 100


def test_list_pairs_against_all_pairs(monkeypatch):
    rnd = random.Random(11)
    monkeypatch.setattr(jaccard_join, "PROBES", 7)
    for _ in range(100):
        n = rnd.randint(0, 60)
        token, label, hood = (np.array([rnd.randint(0, 3) for _ in range(n)], np.int64) for _ in range(3))
        sid, size = np.arange(n), np.array([rnd.randint(1, 30) for _ in range(n)], np.int64)
        place = np.array([rnd.randint(0, max(0, s // 5)) for s in size], np.int64)
        got = set(zip(*jaccard_join.list_pairs(token, sid, size, place, label, hood, 80, 100).tolist(), strict=True))
        assert got == {(i, j) for i, j in itertools.combinations(range(n), 2) if token[i] == token[j] and label[i] != label[j] and hood[i] != hood[j]
                       and 5 * min(size[i], size[j]) >= 4 * max(size[i], size[j]) and 180 * min(size[i] - place[i], size[j] - place[j]) >= 80 * (size[i] + size[j])}


def test_tile_links_span_the_components():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    tokens = [np.unique(np.concatenate([base[rng.random(60) > c], rng.integers(0, 2**63, int(60 * c)).astype(np.uint64)])) for c in rng.uniform(0, 0.3, 60)]
    edges = [(i, j) for i, j in itertools.combinations(range(60), 2) if 100 * (o := len(np.intersect1d(tokens[i], tokens[j]))) >= 80 * (len(tokens[i]) + len(tokens[j]) - o)]
    assert brute_components(range(60), jaccard_join.tile_links(tokens, 80, 100)) == brute_components(range(60), edges)


@pytest.mark.parametrize("texts", [["one two three four five six"], ["a b c d e f g", "h i j k l m n"], [f"w{i} x{i} y{i} z{i} u{i} v{i}" for i in range(20)], ["a b c d e f"] * 3])
def test_jaccard_without_shared_shingles(spark, texts):
    got = jaccard_join.jaccard_components(docs_of(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    sets = [brute_shingles(t) for t in texts]
    assert sorted(map(tuple, got)) == [(i, len(s), sets.index(s)) for i, s in enumerate(sets)]


def test_jaccard_empty(spark):
    assert jaccard_join.jaccard_components(docs_of(spark, [])).count() == 0
    only = jaccard_join.jaccard_components(docs_of(spark, [(1, None, None), (2, "", None)])).collect()
    assert sorted(map(tuple, only)) == [(1, 0, 1), (2, 0, 2)]


# --- PPM


def brute_scores(rows, held, order=3):
    model, counts = ppm.AdaptivePPM(order), Counter()
    tokens = {at: [*WORD.findall(lower(t)), None] for at, (_, t, _) in enumerate(rows)}
    for at, (_, t, _) in enumerate(rows):
        if not held[at]:
            counts.update(tokens[at])
            padded = b"\xff" * order + lower(t).encode() + b"\xff"
            for i in range(order, len(padded)):
                model.update(padded[i - order : i], padded[i])
    total, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (v + 1))) for w in tokens[at]) for at in range(len(rows))]
    return total, counts, tokens, base, [model.read(lower(t).encode(), learn=False) for _, t, _ in rows]


@pytest.mark.parametrize("chunk_bytes", [300, ppm.CHUNK_BYTES])
def test_ppm_scores(spark, monkeypatch, chunk_bytes):
    monkeypatch.setattr(ppm, "FAN", 3)
    rnd = random.Random(8)
    rows = [(i, "".join(rnd.choice("abcé  \n") for _ in range(rnd.randint(0, 80))), "s") for i in range(80)] + [(100 + i, t, "s") for i, t in enumerate(ODD_TEXTS)] + [(None, "zebra äx", "s"), (4, "twice", "s"), (4, "twice", "s")]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 if i is not None else True for i, _, _ in rows]
    assert any(held) and not all(held)
    got = ppm.code_lengths(docs_of(spark, rows), F.crc32(F.col("doc_id").cast("string")) % 10 == 0, chunk_bytes=chunk_bytes).collect()
    total, counts, tokens, base, score = brute_scores(rows, held)
    key = lambda r: (str(r[0]), *map(float, r[1:]))
    want = sorted(((rows[at][0], held[at], len(tokens[at]), sum(counts[w] > 0 for w in tokens[at]), total, base[at], score[at]) for at in range(len(rows))), key=key)
    for g, w in zip(sorted(map(tuple, got), key=key), want, strict=True):
        assert g[:5] == w[:5] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(g[5:], w[5:], strict=True)), (g, w)


def test_ppm_longer_contexts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "FAN", 3)
    rnd = random.Random(12)
    passage = "".join(rnd.choices("abcdé \n", k=300))
    rows = [(i, "".join(rnd.choices("abcé  \n", k=rnd.randint(0, 60))) + passage[at : at + 60], "s") for i, at in enumerate(rnd.choices(range(240), k=60))] + [(100, None, "s"), (101, "", "s"), (None, passage, "s")]
    held = [i is None or i % 5 == 0 for i, _, _ in rows]
    got = ppm.code_lengths(docs_of(spark, rows), F.col("doc_id") % 5 == 0, chunk_bytes=300, orders=(3, 5, 7)).collect()
    scores = {r["id"]: (r["score_3"], r["score_5"], r["score"]) for r in got}
    for at, order in enumerate((3, 5, 7)):
        model = ppm.AdaptivePPM(order)
        for (_, t, _), out in zip(rows, held, strict=True):
            if not out:
                padded = b"\xff" * order + lower(t).encode() + b"\xff"
                for i in range(order, len(padded)):
                    model.update(padded[i - order : i], padded[i])
        for i, t, _ in rows:
            assert math.isclose(scores[i][at], model.read(lower(t).encode(), learn=False), rel_tol=1e-9, abs_tol=1e-9)
    assert scores[None][1] > scores[None][0]  # a repeated passage is cheaper with the longer contexts
    with pytest.raises(ValueError):
        ppm.code_lengths(docs_of(spark, rows), F.lit(False), orders=(8,))


def test_ppm_is_a_distribution_and_learns(spark):
    model = ppm.AdaptivePPM()
    model.read(b"abracadabra abracadabra", learn=True)
    for context in (b"abr", b"zzz", b"\xff\xff\xff", b"zab"):
        assert math.isclose(sum(10 ** model.log10(context, s) for s in range(256)), 1.0)
    rows = [(1, "ab" * 200, "s"), (2, "".join(random.Random(9).choices("abcdefghijklmnop", k=400)), "s"), (3, None, "s")]
    scores = dict(map(tuple, ppm.adaptive_code_lengths(docs_of(spark, rows)).collect()))
    assert scores[1] > 3 * scores[2] / 4 and math.isclose(scores[3], -math.log10(256))
    assert ppm.code_lengths(docs_of(spark, []), F.lit(False)).count() == 0
    nothing = ppm.code_lengths(docs_of(spark, rows), F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in nothing)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_ppm_predicts_held_out_text(spark):
    rnd = random.Random(10)
    words = ["".join(rnd.choices("aeioutrnsl", k=rnd.randint(2, 6))) for _ in range(60)]
    rows = [(i, " ".join(rnd.choices(words, k=40)), "s") for i in range(120)]
    got = ppm.code_lengths(docs_of(spark, rows), F.col("doc_id") % 10 == 0).collect()
    chars = {i: len(t) + 1 for i, t, _ in rows}
    bits = [-r["score"] / math.log10(2) / chars[r["id"]] for r in got if r["held_out"]]
    assert max(bits) < 2.8 < math.log2(11)  # an order-0 model of eleven characters needs over three
