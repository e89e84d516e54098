"""Registered queries of the subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gainkit.llm import codes, embed, lexical, linededup, minhash, mixing, pii, quality, spbpe, suffix, tokenfile, toxicity, warc
from gainkit.session import Scratch
from gainkit.sources.tables import read_table


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op1") as scratch:
        return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), scratch, k=3, threshold=Fraction(85, 100))


def damaged(pages: DataFrame) -> DataFrame:
    """A second replica of the pages: of every 97 records by id one has a byte
    of its body changed and one is lost."""
    kind = F.col("page_id") % 97
    body = F.when(kind == 13, F.concat(F.lit("\u0001"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    return pages.filter(kind != 41).withColumn("html", body)


def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    with Scratch(spark, "op2") as scratch:
        found = warc.audit(pages, damaged(pages), scratch)
        return found.select(F.col("k").alias("page_id"), "start", "n_bytes", F.col("leaf").alias("sha256"), "status")


OP2_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id || '>'
    || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
    || chr(13) || chr(10) || chr(13) || chr(10) AS rec
  FROM pages)
SELECT page_id, CAST(sum(strlen(rec)) OVER (ORDER BY page_id) - strlen(rec) AS BIGINT) AS start, CAST(strlen(rec) AS BIGINT) AS n_bytes, sha256(rec) AS sha256,
       CASE page_id % 97 WHEN 13 THEN 'corrupt' WHEN 41 THEN 'missing' ELSE 'ok' END AS status
FROM r
"""


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op3") as scratch:
        places = tokenfile.write(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), scratch)
        return tokenfile.read(places)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(read_table(spark, sf_dir, "documents"))


def op5_pivot_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op5") as scratch:
        return embed.near_duplicates(read_table(spark, sf_dir, "embeddings"), scratch)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spbpe.digests(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op7") as scratch:
        return suffix.kept_digests(read_table(spark, sf_dir, "documents"), scratch)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(read_table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return m.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).cast("long").alias("taken"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    chain = toxicity.fit(docs, labels, {"junk": 1 - F.col("quality"), "toxic": F.col("toxic")})
    return toxicity.score(docs, chain)


def op11_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op11") as scratch:
        return codes.compress(read_table(spark, sf_dir, "embeddings"), scratch)


def _op11_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """The rounds written one after the other; vectors of one length."""
    steps = [f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT vec_id, label, part, q[part * len(q) // {parts} + 1 : (part + 1) * len(q) // {parts}] AS v FROM k, range({parts}) r(part)),
b0 AS MATERIALIZED (
  SELECT part, entry, v FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM p) WHERE entry < {entries}),"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT p.vec_id, p.label, p.part, p.v, min({{'d': list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'e': b.entry}}) AS best
  FROM p JOIN b{n} b ON p.part = b.part GROUP BY p.vec_id, p.label, p.part, p.v),""")
        if n < rounds:
            steps.append(f"""
m{n} AS (
  SELECT part, entry, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT part, best.e AS entry, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{n}) GROUP BY part, entry, pos),
b{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{n} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS v FROM m{n} GROUP BY part, entry) m
  ON b.part = m.part AND b.entry = m.entry),""")
    steps.append(f"""
h AS (SELECT sha256(coalesce(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry), '')) AS codebooks_sha256 FROM b{rounds}),
c AS (
  SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM c, h
""")
    return "".join(steps)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op12") as scratch:
        d = linededup.deduplicate(read_table(spark, sf_dir, "documents"), scratch, keep=["doc_id"])
        return d.select(F.col("_doc.doc_id").alias("doc_id"), F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
                        F.sha2("_text", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS key FROM l),
c AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, pos, line, c.key IS NOT NULL AND c.top <> k.doc_id AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Scratch(spark, "op13") as scratch:
        return lexical.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), scratch)


OP13_SQL = r"""
WITH q AS MATERIALIZED (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY item_id, term),
t AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents) GROUP BY doc_id, term),
d AS MATERIALIZED (SELECT doc_id, sum(tf)::BIGINT AS n FROM t GROUP BY doc_id),
s AS MATERIALIZED (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM d),
w AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM t WHERE term IN (SELECT term FROM q) GROUP BY term), s),
i AS MATERIALIZED (
  SELECT t.doc_id, t.term, w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 75 + (75 * d.n * s.docs) // s.terms))) AS impact
  FROM t JOIN w ON t.term = w.term JOIN d ON t.doc_id = d.doc_id, s),
r AS (SELECT q.item_id, i.doc_id, sum(q.times * i.impact)::BIGINT AS score FROM q JOIN i ON q.term = i.term GROUP BY q.item_id, i.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (
  SELECT *, (sum(words) OVER () * 1.5::DOUBLE - coalesce(sum(words) OVER o, 0) * 2) / sum(weight) OVER r AS level
  FROM w WINDOW o AS (ORDER BY words / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                r AS (ORDER BY words / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
f AS (SELECT arg_min(level, words / weight) AS level FROM l WHERE words * 2 > level * weight),
t AS (
  SELECT source, words, CASE WHEN words * 2 <= l.level * weight THEN (words * 2)::DOUBLE
                             ELSE least(f.level * weight, (words * 2)::DOUBLE) END AS target
  FROM l LEFT JOIN f ON true),
h AS (
  SELECT *, length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::INT AS stratum,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS hash FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY stratum, hash, doc_id) AS rank FROM h),
c AS (
  SELECT k.*, t.words AS source_size, t.target, CASE WHEN t.words > 0 THEN t.target / t.words ELSE 0.0::DOUBLE END AS step,
         ('0x' || substr(md5('offset:0:' || coalesce(k.source, chr(0) || 'null')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS start
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(step * rank + start) - floor(step * (rank - 1) + start)) AS BIGINT) AS taken
FROM c
"""

QUERIES = {f.__name__: f for f in (
    op1_minhash_neardup, op2_merkle_fixity, op3_token_files, op4_pii, op5_pivot_neardup, op6_byte_bpe, op7_suffix_dedup,
    op8_quality_rules, op9_source_mix, op10_toxicity, op11_code_compression, op12_line_dedup,
    op13_lexical_search)}
SQL = {"op2_merkle_fixity": OP2_SQL, "op9_source_mix": OP9_SQL, "op11_code_compression": _op11_sql(), "op12_line_dedup": OP12_SQL,
       "op13_lexical_search": OP13_SQL}
