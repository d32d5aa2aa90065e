"""Token files, vector codes and collocations against brute force, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tests.conftest import SF_SMALL
from tests.llm.test_arrow import ODD_TEXTS, docs_of, lower
from tokenizers import Tokenizer

import __spark_entry__ as E
from pyspark.sql import functions as F
from strata.llm import collocations, token_files, vector_codes, warc

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


# --- token files


def test_ids_by_word_are_those_of_the_text(tokenizer, monkeypatch):
    rnd = random.Random(3)
    alphabet = "aB1'é .,\t\n\r\x0b\x0c\x1c\x85\xa0  ́İΣσ½ǆ한日<|>\U0001f600￾́"
    texts = [*(t or "" for t in ODD_TEXTS), "it's we'LL 12 34", "<|endoftext|> a<|startoftext|>b", "e ́ à", " " * 50_000, "ab" * 40_000]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(2000)]
    plain = "aBsStTrReEvVlLmMdD''ÀéßÞ×÷Ÿ 12.,\t\n"
    texts += ["".join(rnd.choice(plain) for _ in range(rnd.randint(0, 60))) for _ in range(4000)] + ["'", "a'", "'s", "''s", "x'll", "x'l", "don't've", "\"'re", "'", "é'Ré", "'"]
    for held in (token_files.WORDS_HELD, 500):
        monkeypatch.setattr(token_files, "WORDS_HELD", held)
        for text, ids in zip(texts, token_files.text_ids(PATH, pa.array(texts), 2), strict=True):
            assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text[:80]
    assert [i.tolist() for i in token_files.text_ids(PATH, pa.array([None, ""], pa.string()), 2)] == [[2], [2]]
    monkeypatch.setattr(token_files, "SLICE_BYTES", 40)
    long = ["It's a long text, cut at blanks \u00e9\u0301 and " * 30, "x" * 500, "word " * 50 + "y" * 300 + " end", "no\tblank\nbut\rthese" * 40]
    for text, ids in zip(long, token_files.text_ids(PATH, pa.array(long), 2), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2], text[:80]
    other = public_tokenizers.path("byte_bpe_50k.json")  # white space counts there
    assert next(token_files.text_ids(other, pa.array(["a  b"]), 2)).tolist() == [*Tokenizer.from_file(other).encode("a  b", add_special_tokens=False).ids, 2]


def expected(tokenizer, rows):
    """Rows (id, start, n_tokens, crc32); rows of one id may stand in any order, so starts are left out for those."""
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_round_trip(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 1000)
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choices(["alpha", "beta", "gamma", "Δelta", "x1"], k=rnd.randint(0, 60)))) for i in rnd.sample(range(-500, 5000), 300)]
    rows += [(6000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(7, "same")] * 3 + [(7, "other words"), (None, "no id"), (None, None)]
    uri = warc.shared_uri(spark, "token-test")
    index = token_files.write_token_files(docs_of(spark, [(i, t, "s") for i, t in rows]).repartition(5), PATH, uri, file_bytes=1500)
    got = [(r["id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in token_files.read_token_files(index).collect()]
    want = expected(tokenizer, rows)
    ids = Counter(r[0] for r in want)
    unique = lambda rs: sorted(r for r in rs if r[0] is not None and ids[r[0]] == 1)
    assert unique(got) == unique(want)
    assert Counter((r[0], *r[2:]) for r in got) == Counter((r[0], *r[2:]) for r in want)
    places = sorted((start, n) for _, start, n, _ in got)
    assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:]))  # no gaps, no overlaps
    by_start = [i for _, i in sorted((start, math.inf if i is None else i) for i, start, _, _ in got)]
    assert by_start == sorted(by_start)
    # Each file's own footer says the same as the index table.
    files = defaultdict(list)
    for r in index.collect():
        files[r["file"]].append((r["offset"], r["n_tokens"]))
    assert len(files) > 5
    for file, places in files.items():
        assert [tuple(p) for p in token_files.footer(file).tolist()] == sorted(places)
    one = token_files.read_token_files(index, F.col("id") == 6003).collect()
    assert [(r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in one] == [(6003, [*tokenizer.encode("one", add_special_tokens=False).ids, 2])]


def test_dictionary_is_shared_and_checked(spark, tokenizer):
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghij", k=6)) for _ in range(40)]
    rows = [(i, " ".join(rnd.choices(words, k=12)), "s") for i in range(400)]
    docs = docs_of(spark, rows)
    sizes = []
    for sample in (0, 400):
        uri = warc.shared_uri(spark, "token-test")
        index = token_files.write_token_files(docs, PATH, uri, sample=sample)
        sizes.append(index.agg(F.sum("n_bytes")).first()[0])
        assert token_files.read_token_files(index).count() == 400
    assert sizes[1] < 0.8 * sizes[0]
    with token_files._open(index.first()["file"], "r") as src:
        _, digest = token_files._head(src)
    assert digest != token_files.NO_DICTIONARY and token_files.load_dictionary(uri, digest)
    with token_files._open(token_files._dictionary_uri(uri, digest), "w") as out:
        out.write(b"another dictionary")
    with pytest.raises(ValueError):
        token_files.load_dictionary(uri, digest)


def test_token_files_empty(spark):
    index = token_files.write_token_files(docs_of(spark, []), PATH, warc.shared_uri(spark, "token-test"))
    assert index.count() == 0 and token_files.read_token_files(index).count() == 0


def test_op11_query(spark, tokenizer):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = E.queries()["op11_token_files"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == expected(tokenizer, rows)


# --- vector codes


def test_nearest_is_exact():
    rng = np.random.default_rng(6)
    for entries, spread in ((1, 9), (5, 3), (256, 40), (256, 2)):  # small spreads have many ties
        book = rng.integers(-spread, spread + 1, (entries, 4))
        parts = rng.integers(-spread * 2, spread * 2 + 1, (500, 4))
        for count in (1, 6):
            pivots = vector_codes.choose_pivots(book, count)
            to, of = vector_codes.roots(parts, pivots), vector_codes.roots(book, pivots)
            exact = vector_codes.squared(parts[:, None], book[None])
            assert (vector_codes.lower_bounds(to, of).astype(float) ** 2 <= exact).all()
            index, best, evaluated = vector_codes.nearest(parts, book, to, of)
            assert (index == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
            assert evaluated <= exact.size + len(parts)
    # Bounds do rule entries out.
    book = np.cumsum(rng.integers(50, 90, (256, 4)), axis=0)
    parts = book[rng.integers(0, 256, 400)] + rng.integers(-9, 9, (400, 4))
    pivots = vector_codes.choose_pivots(book, 6)
    assert vector_codes.nearest(parts, book, vector_codes.roots(parts, pivots), vector_codes.roots(book, pivots))[2] < 0.5 * 400 * 256


def brute_codes(rows, parts=4, entries=256, rounds=4):
    rows = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    width = len(rows[0][1]) // parts
    x = [[[math.floor(1024 * c) for c in v[p * width : (p + 1) * width]] for p in range(parts)] for _, v, _ in rows]
    books = [[r[p] for r in x[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(r[p], e)), j) for j, e in enumerate(books[p])) for p in range(parts)] for r in x]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [r[p] for r, f in zip(x, found) if f[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    return [(r[0], r[2], "".join(f"{j:02x}" for _, j in f), sum(d for d, _ in f)) for r, f in zip(rows, assign())]


VECTORS = "vec_id long, embedding array<float>, label int, code string, x string, near string, v string"


@pytest.mark.parametrize("n, dims", [(400, 8), (30, 4)])
def test_quantise(spark, n, dims):
    rng = np.random.default_rng(n)
    as_float = lambda v: [float(np.float32(c)) for c in v]
    rows = [(int(i), as_float(rng.normal(rng.integers(0, 3), 0.2, dims)), int(i) % 3) for i in rng.permutation(n)]
    rows += [rows[0], (None, as_float(rng.normal(0, 1, dims)), None), (None, as_float(rng.normal(0, 1, dims)), 1), (n + 1, [0.0] * dims, None), (n + 2, [-1e5] * dims, None)]
    odd = [(-1, None, 0), (-2, [], 0), (-3, [None] * dims, 0), (-4, [math.nan] + [0.0] * (dims - 1), 0), (-5, [math.inf] + [0.0] * (dims - 1), 0), (n + 9, [0.5] * (dims + 4), 0)]
    frame = spark.createDataFrame([(*r, *["x"] * 4) for r in rows + odd], VECTORS).repartition(4)
    coded = vector_codes.with_label_error(vector_codes.quantise(frame)).collect()
    want = brute_codes(rows + odd)
    key = lambda r: tuple((c is None, c or 0) for c in r)
    assert sorted(((r["vec_id"], r["label"], r["code"], r["error"]) for r in coded), key=key) == sorted(want, key=key)
    per_label = Counter()
    for _, label, _, error in want:
        per_label[label] += error
    assert all(r["label_error"] == per_label[r["label"]] for r in coded)
    assert len({r["codebooks_sha256"] for r in coded}) == 1


def test_quantise_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_codes.with_label_error(vector_codes.quantise(empty)).count() == 0
    assert vector_codes.quantise(spark.createDataFrame([(1, [1.0] * 6, 1, *["x"] * 4)], VECTORS)).count() == 0  # no four equal parts
    with pytest.raises(ValueError):
        vector_codes.quantise(spark.createDataFrame([(1, [1e30] * 8, 1, *["x"] * 4)], VECTORS))


# --- collocations


def brute_phrases(rows, least, longest=5, top=2000):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        ranked = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * c >= 100 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in candidates.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


PHRASES = "text string, lang string, word string, n long, f long, key string, phrase string, prefix string"


@pytest.mark.parametrize("small", [False, True])
def test_collocations(spark, monkeypatch, small):
    if small:  # many flushes, buckets and hot prefixes
        for name, value in (("BUCKET", 50), ("HOT", 8), ("SPREAD", 3)):
            monkeypatch.setattr(collocations, name, value)
    rnd = random.Random(7)
    words = ["en", "de", "a", "b", "é", "The", "x#1", "İ", "of"]
    rows = []
    for _ in range(250):
        chosen = rnd.choices(words, [9, 7, 6, 5, 3, 3, 2, 1, 9], k=rnd.randint(0, 30))
        rows.append(("".join(w + rnd.choice([" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b"]) for w in chosen), rnd.choice(["en", "de", "", None, "und"])))
    rows += [("one fixed phrase of many words here", "en")] * 12 + [(t, "en") for t in ODD_TEXTS] + [(None, None), ("", None), (" .,! \n", "zz"), ("once", "only")]
    frame = spark.createDataFrame([(*r, "x", 1, 1, "x", "x", "x") for r in rows], PHRASES).repartition(4)
    got = collocations.collocations(frame, least=12, top=40, chunk=64 if small else collocations.CHUNK)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_phrases(rows, 12, top=40)
    assert any(len(r[2].split()) == 5 for r in want) and sorted(map(tuple, got.collect())) == want


def test_collocations_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], PHRASES)).count() == 0
    alone = spark.createDataFrame([("rare words only", "en", "x", 1, 1, "x", "x", "x"), (None, None, "x", 1, 1, "x", "x", "x")], PHRASES)
    assert collocations.collocations(alone).count() == 0
