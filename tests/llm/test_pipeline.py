"""Each pipeline stage against brute force on its own input, and the registered queries that have no SQL."""

import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tests.conftest import SF_SMALL
from tests.llm.test_arrow import brute_components, brute_lines, brute_measures, brute_scores, brute_shingles
from tests.llm.test_native import brute_base, filled

import __spark_entry__ as E
import corpus_pipeline
from strata.llm import packing, queries
from strata.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def staged(spark):
    """Rows before the first stage and after every stage."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage-test")
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
        if len(out) < 6:
            assert docs.columns == COLUMNS
    return out


def rows(stage):
    return [(r["doc_id"], r["text"], r["source"]) for r in stage]


def key(r):
    return tuple((x is None, str(x)) for x in r)


def linked(docs):
    sets = [brute_shingles(t) for _, t, _ in docs]
    edges = [(a, b) for a, b in itertools.combinations(range(len(docs)), 2)
             if sets[a] and sets[b] and 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    comp = brute_components(range(len(docs)), edges)
    low = {}
    for at, c in comp.items():
        low[c] = min(low.get(c, 10**12), docs[at][0])
    return [(docs[at][0], len(sets[at]), low[comp[at]]) for at in range(len(docs))]


def failing(text):
    m = brute_measures(text)
    return m[0] < 50 or 100 * m[4] > 50 * m[0]


def test_quality_stage_keeps_clean_documents(staged):
    before, after = rows(staged[0]), rows(staged[1])
    # no source here comes near rejection, once its rate is shrunk
    assert sorted(after, key=key) == sorted((r for r in before if not failing(r[1])), key=key)


def test_line_stage(staged):
    want = [(i, t) for i, t, _, _ in brute_lines(rows(staged[1]), 6, 1)]
    assert sorted(((r["doc_id"], r["text"]) for r in staged[2]), key=key) == sorted(want, key=key)
    assert all(r["n_chars"] == len(r["text"]) for r in staged[2])


def test_near_duplicate_stage(staged):
    want = {i for i, _, low in linked(rows(staged[2])) if i == low}
    assert sorted(r["doc_id"] for r in staged[3]) == sorted(want) and len(want) < len(staged[2])


def test_near_duplicates_by_row(spark):
    """Rows that repeat an id or have none are rows of their own; equal rows with words leave one."""
    text, near, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    near = text.replace("a59", "z")
    data = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (1, near, "en", "s", 1), (None, text, "en", "s", 1), (None, other, "en", "s", 1), (None, other, "de", "s", 1),
            (5, other, "en", "s", 1), (6, None, "en", "s", 1), (6, None, "en", "s", 1), (7, "", "en", "s", 1), (None, "alone " * 9, None, None, None), (8, "few words", "en", "s", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    path = scratch_path(spark, "rows")
    docs.write.parquet(path)
    got = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, spark.read.parquet(path), SF_SMALL).collect()), key=key)
    want = [r for r in data if r[0] in (5, 6, 7, 8) or r[1] == "alone " * 9]
    first = [r for r in got if r[0] == 1]
    assert len(first) == 1 and first[0][1] in (text, near)
    assert [r for r in got if r[0] != 1] == sorted(want, key=key)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), SF_SMALL).count() == 0


def test_mix_stage(staged):
    before, after = rows(staged[3]), Counter(rows(staged[4]))
    words = {r: brute_measures(r[1])[0] for r in before}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before:
        sizes[r[2]] += words[r]
        taken[r[2]] += words[r] * after[r]
    assert set(after) <= set(before) and max(after.values()) <= 3
    for source, target in filled(sizes).items():
        assert abs(taken[source] - target) <= 3 * max(words[r] for r in before if r[2] == source)


def test_pack_stage(staged):
    check_packing([(r["doc_id"], r["text"], r["source"]) for r in staged[4]], staged[5])


def check_packing(docs, packed):
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want, total = Counter(), 0
    for i, t, _ in docs:
        ids = [*encode(t or ""), 2]
        total += len(ids)
        for no, (start, n) in enumerate(packing.cut(len(ids), 1024)):
            want[i, no, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
    room = []  # no more sequences than best fit takes, longest first
    for size in sorted((n for _, _, _, n, _ in want.elements()), reverse=True):
        fits = [r for r in room if r >= size]
        if fits:
            room.remove(min(fits))
        room.append((min(fits) if fits else 1024) - size)
    assert math.ceil(total / 1024) <= len(sequences) <= len(room)


def test_run_returns_the_last_stage(spark, staged):
    got = E.queries()["pipeline"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    pick = lambda r: (r["doc_id"], r["piece"], r["length"], r["ids_crc32"])
    assert Counter(map(pick, got.collect())) == Counter(map(pick, staged[5]))
    assert "pipeline" not in E.oracle_sql()


def test_packing_query(spark, documents):
    check_packing(documents, queries.op1_best_fit_packing(spark, SF_SMALL).collect())


def test_jaccard_query(spark, documents):
    got = queries.op3_ngram_jaccard(spark, SF_SMALL).collect()
    assert sorted(map(tuple, got)) == sorted(linked(documents))


def test_secret_query(spark, documents):
    text = {i: t or "" for i, t, _ in documents}
    found = 0
    for r in queries.op4_secret_scan(spark, SF_SMALL).collect():
        base = brute_base(text[r["doc_id"]])
        names = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base)
        assert r["base_sha256"] == hashlib.sha256(names.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == j for _, k, _ in base) for j in range(3)]
        assert set(filter(None, names.split(","))) <= set(r["spans"].split(","))
        assert {s.split(":")[0] for s in r["spans"].split(",") if s} <= {"assign", "access", "hex", "random"}
        found += len(base)
    assert found


def test_ppm_query(spark, documents):
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in documents]
    total, counts, tokens, base, score = brute_scores(documents, held, order=5)
    got = {r["doc_id"]: r for r in queries.op8_ppm_scores(spark, SF_SMALL).collect()}
    for at, (i, _, _) in enumerate(documents):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[at], len(tokens[at]), sum(counts[w] > 0 for w in tokens[at]), total)
        assert math.isclose(r["base_score"], base[at], rel_tol=1e-9) and math.isclose(r["score"], score[at], rel_tol=1e-9)
    # what it has not read takes under half the bits of a byte
    size = sum(len((t or "").encode()) + 1 for at, (_, t, _) in enumerate(documents) if held[at])
    assert -sum(got[i]["score"] for at, (i, _, _) in enumerate(documents) if held[at]) / math.log10(2) < 4 * size


@pytest.mark.parametrize("name", sorted(n for n in E.LLM_QUERIES if n in E.oracle_sql()))
def test_queries_with_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = E.queries()[name](spark, SF_SMALL)
    want = con.execute(E.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    assert sorted((tuple(plain(r[c]) for c in names) for r in got.collect()), key=key) == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=key)
