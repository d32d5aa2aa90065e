"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from strata.llm import collocations, exact_dedup, jaccard_join, line_dedup, mixing, packing, ppm, quality_rules, secrets, sharding, token_files, vector_codes, warc
from strata.llm.registry import register, table
from strata.session import scratch_path

# The ranks of byte_bpe_50k.json for the faster of two installed encoders; tests hold the ids against the tokenizers library.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD = r"[^\x20\x09-\x0D]+"


@register("op5_exact_dedup", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op5_exact_dedup(spark, sf_dir):
    """Exact duplicates of whole texts; the largest doc_id of equal texts stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="max").withColumnRenamed("id", "doc_id")


@register("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    """Pattern and randomness spans of every whole text."""
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind_no"] < len(secrets.PATTERNS))
    counts = [secrets.count_kind(F.col("spans"), kind).alias(f"n_{kind}") for kind in secrets.PATTERNS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"))


SHARD_LIMIT = 1 << 20
SHARD_DEPTH_SQL = 24  # deeper than any shard of 1 MiB gets within a hundred thousand documents


@register("op9_extendible_sharding", f"""
WITH sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes,
         (('0x' || md5(doc_id::VARCHAR)[1:16])::UBIGINT)::BIT::VARCHAR AS bits FROM documents),
small AS (SELECT * FROM sized WHERE n_bytes <= {SHARD_LIMIT}),
levels AS (SELECT doc_id, n_bytes, d, bits[1:d] AS head FROM small, range(0, {SHARD_DEPTH_SQL + 1}) AS r(d)),
buckets AS (SELECT d, head, sum(n_bytes)::BIGINT AS shard_bytes FROM levels GROUP BY d, head HAVING sum(n_bytes) <= {SHARD_LIMIT})
SELECT doc_id, n_bytes, arg_min(head, d) AS shard, min(d)::BIGINT AS depth, arg_min(shard_bytes, d) AS shard_bytes
FROM levels JOIN buckets USING (d, head) GROUP BY doc_id, n_bytes
""")
def op9_extendible_sharding(spark, sf_dir):
    """Shards of at most 1 MiB of text by hash prefix."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARD_LIMIT).withColumnRenamed("id", "doc_id")


MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
             [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS w
      FROM d GROUP BY source),
ordered AS (SELECT *, source_size::DOUBLE * 3 AS cap, sum(source_size::DOUBLE) OVER () AS total,
                   coalesce(sum(source_size::DOUBLE * 3) OVER (ORDER BY source_size::DOUBLE * 3 / w, source IS NULL, encode(source)
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                   sum(w) OVER (ORDER BY source_size::DOUBLE * 3 / w, source IS NULL, encode(source)
                            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s),
lvl AS (SELECT max((total - capped) / rest) AS level FROM ordered WHERE (total - capped) / rest * w <= cap),
targets AS (SELECT source, source_size, least(cap, level * w) AS target,
                   ('0x' || md5('7:' || coalesce(source, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE AS start FROM ordered, lvl),
placed AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.start,
                  CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
                  (row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) - 1)::DOUBLE AS k
           FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(start + (k + 1) * rate) - floor(start + k * rate)))::BIGINT AS taken FROM placed
"""


@register("op10_source_mix", MIX_SQL)
def op10_source_mix(spark, sf_dir):
    """Words taken of each document so that sources meet their target weights."""
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register("op2_line_dedup", rf"""
WITH numbered AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw,
                         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, pos, raw, CASE WHEN source IS NULL THEN '-' ELSE '=' || source END AS site, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM numbered),
long_enough AS (SELECT * FROM l WHERE regexp_matches(line, '{line_dedup.at_least_words(1)}')),
spread AS (SELECT line, arg_min((doc_id, pos), (doc_id, pos)) AS first FROM long_enough GROUP BY line HAVING count(DISTINCT site) >= 6),
gone AS (SELECT doc_id, pos FROM long_enough JOIN spread USING (line) WHERE (doc_id, pos) <> first),
rebuilt AS (SELECT l.doc_id, string_agg(raw, chr(10) ORDER BY l.pos) FILTER (WHERE gone.pos IS NULL) AS text,
                   count(*) AS n_lines, count(gone.pos) AS n_removed
            FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents d LEFT JOIN rebuilt r USING (doc_id)
""")
def op2_line_dedup(spark, sf_dir):
    """Documents without the lines that stand at six or more sources, but for each line's first place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.dedup_lines(docs).select("doc.doc_id", "doc.text", "n_lines", "n_removed")


@register("op7_host_rules", rf"""
WITH w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
           FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents)),
win AS (SELECT doc_id, i, word AS a, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win WHERE c IS NOT NULL) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM twice, range(0, 3) AS r(j) GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
m AS (SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS n_words,
             length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
             len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM documents d LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS failed FROM f GROUP BY source),
t AS (SELECT count(*) AS hosts, sum(n) AS n, sum(failed) AS failed, sum(failed) / sum(n) AS mean FROM h),
v AS (SELECT t.mean, t.mean * (1 - t.mean) AS noise,
             sum(h.n * (h.failed / h.n - t.mean) ** 2) / any_value(t.n) - t.mean * (1 - t.mean) * any_value(t.hosts) / any_value(t.n) AS between_var
      FROM h, t GROUP BY t.mean),
prior AS (SELECT mean, CASE WHEN between_var > 0 THEN least(greatest(noise / between_var - 1, 1), 1e6) ELSE 1e6 END AS weight FROM v),
bad AS (SELECT source FROM h, prior WHERE (failed + mean * weight) / (n + weight) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT EXISTS (SELECT 1 FROM bad WHERE bad.source IS NOT DISTINCT FROM f.source) AS kept FROM f
""")
def op7_host_rules(spark, sf_dir):
    """Base quality rules of every whole text, and the verdict of its source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = scratch_path(spark, "quality-measures")  # a few longs per document, measured once for both readers
    quality_rules.measure(docs).write.parquet(path)
    judged = quality_rules.judge(spark.read.parquet(path))
    return judged.select("doc.doc_id", *quality_rules.METRICS, "base_failed", "kept")


@register("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 1024 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, {"ids_crc32": F.crc32("ids")})
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op6_warc_normalise", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
g AS (SELECT payload, max(page_id) AS best FROM p WHERE octet_length(payload) >= 1000 GROUP BY payload HAVING count(*) > 1)
SELECT page_id, octet_length(p.payload)::BIGINT AS payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN best <> page_id THEN best END AS refers_to
FROM p LEFT JOIN g ON p.payload = g.payload
""")
def op6_warc_normalise(spark, sf_dir):
    """All pages through monolithic archives, the normaliser and the offset index, and back."""
    index = warc.archive(table(spark, sf_dir, "pages"), warc.shared_uri(spark, "warc"))
    read = warc.read_indexed(index)
    return read.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@register("op3_ngram_jaccard")
def op3_ngram_jaccard(spark, sf_dir):
    """Components of documents whose five-word shingle sets reach a Jaccard similarity of 0.8."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@register("op8_ppm_scores")
def op8_ppm_scores(spark, sf_dir):
    """Unigram and PPM scores (contexts of up to five bytes; ``score_3``: three) of every document, learned from nine tenths of them."""
    docs = table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    return ppm.code_lengths(docs, held, orders=(ppm.ORDER, 5)).withColumnRenamed("id", "doc_id")


WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@register("op11_token_files")
def op11_token_files(spark, sf_dir):
    """All documents as token files, read back through their index."""
    index = token_files.write_token_files(table(spark, sf_dir, "documents"), WORD_TOKENIZER, warc.shared_uri(spark, "token-files"))
    read = token_files.read_token_files(index)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Every round as a query of its own: distances of all parts to all entries, the least one, the floored means."""
    steps = [f"""
WITH clean AS (SELECT vec_id, label, embedding AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS no FROM clean),
x AS MATERIALIZED (
  SELECT no, ((i - 1) // (n // {parts}))::INT AS part, ((i - 1) % (n // {parts}))::INT AS place, floor({scale} * v[i]::DOUBLE)::BIGINT AS c
  FROM (SELECT no, v, len(v) AS n, unnest(range(1, len(v) + 1)) AS i FROM v)),
book0 AS MATERIALIZED (SELECT part, no - 1 AS entry, place, c FROM x WHERE no <= {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
near{r} AS MATERIALIZED (
  SELECT no, part, min((d, entry)) AS best
  FROM (SELECT no, part, entry, sum((x.c - b.c) * (x.c - b.c))::BIGINT AS d FROM x JOIN book{r} b USING (part, place) GROUP BY no, part, entry)
  GROUP BY no, part)""")
        if r < rounds:
            steps.append(f"""
mean{r} AS (SELECT x.part, best[2] AS entry, place, sum(c) AS s, count(*) AS n FROM x JOIN near{r} USING (no, part) GROUP BY x.part, best[2], place),
book{r + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, CASE WHEN n IS NULL THEN b.c ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS c
  FROM book{r} b LEFT JOIN mean{r} m USING (part, entry, place))""")
    return ",".join(steps) + f""",
digest AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds}),
coded AS (SELECT no, string_agg(format('{{:02x}}', best[2]), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY no)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM v JOIN coded USING (no), digest
"""


@register("op12_vector_codes", _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE))
def op12_vector_codes(spark, sf_dir):
    """Product-quantisation codes of all vectors, with their errors and the codebooks' hash."""
    coded = vector_codes.with_label_error(vector_codes.quantise(table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@register("op13_collocations", rf"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?
-
]')), '[^ 	]+') AS ws FROM d),
w AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p WHERE len(ws) > 0),
f AS MATERIALIZED (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*)::BIGINT AS f
  FROM w, range(1, {collocations.LONGEST + 1}) AS r(k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
n AS (SELECT lang, count(*)::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1),
inside AS (
  SELECT DISTINCT c.lang, array_to_string(string_split(c.phrase, ' ')[b:b + part - 1], ' ') AS phrase, c.f
  FROM c, range(2, {collocations.LONGEST}) AS s(part), range(1, {collocations.LONGEST}) AS q(b) WHERE part < c.k AND b + part - 1 <= c.k),
covered AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN covered USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * f),
cut AS (SELECT lang, phrase, f AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS l_phrase, array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS r_phrase
        FROM kept, range(1, {collocations.LONGEST}) AS r(j) WHERE j < k),
scored AS (SELECT cut.lang, cut.phrase, a, j, fl.f AS l, fr.f AS r, n, ((1000::HUGEINT * a * n) // (fl.f::HUGEINT * fr.f))::BIGINT AS score
           FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.phrase = l_phrase JOIN f fr ON fr.lang = cut.lang AND fr.phrase = r_phrase JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {collocations.TOP}
""")
def op13_collocations(spark, sf_dir):
    """The first 2,000 phrases of two to five words of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
