"""Queries that apply each operator to its whole table, and SQL where it can state the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.llm import (
    bpe,
    grades,
    importance,
    licences,
    line_rules,
    mixing,
    mtree,
    packing,
    phrases,
    pii,
    simhash,
    token_store,
    warc,
)
from cadastre.llm.common import table
from cadastre.sources.scratch import scratch_folder

MULTI_RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"), scratch_folder(spark), min_bytes=0)


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("mix")
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id",
        *[m[c].alias(c) for c in ("size", "source_size", "target")],
        (m["size"] * m["copies"]).alias("taken"),
        m["shards"].alias("shards"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(MULTI_RANKS)
    return bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.quality_report(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op6_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = grades.train(docs, grades.grades_of(table(spark, sf_dir, "labels")))
    return grades.graded(docs, model)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.train(docs))
    families = F.array_join(F.array_sort(F.array_distinct("licences.family")), ",")
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_licences"),
        F.size(F.filter("licences", lambda x: x["confirmed"])).cast("long").alias("n_confirmed"),
        families.alias("families"),
        F.array_join(F.transform("licences", lambda x: F.concat_ws(":", x["paragraph"], x["family"])), ",").alias("places"),
    )


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    return token_store.stored_digests(table(spark, sf_dir, "documents"), scratch_folder(spark), path)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree.quantised(table(spark, sf_dir, "embeddings"))
    found = mtree.top_k(vectors, vectors.filter(F.col("id") % 100 == 0))
    return found.withColumnRenamed("id", "vec_id")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return packing.pack(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_mix, op3_simhash, op4_bpe, op5_line_rules, op6_grades, op7_licences,
        op8_token_store, op9_top_k, op10_pii, op11_packing, op12_importance, op13_phrases, pipeline,
    )
}

ORACLE = {
    "op5_line_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, a, b, c) AS n
  FROM (SELECT r, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS p FROM d))),
covered AS (
  SELECT r, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q FROM windows WHERE n > 1) GROUP BY r),
lines AS (
  SELECT r, source, text, line,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
           'abcdefghijklmnopqrstuvwxyz000000000'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, source, text, unnest(string_split(body, chr(10))) AS line FROM d)),
dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE n > 0 GROUP BY r),
frequent AS (
  SELECT source, norm FROM lines WHERE norm <> '' GROUP BY source, norm HAVING count(DISTINCT text) > 20),
removed AS (
  SELECT l.r, sum(l.n) AS removed FROM lines l JOIN frequent f
  ON l.norm = f.norm AND l.source IS NOT DISTINCT FROM f.source GROUP BY l.r),
figures AS (
  SELECT doc_id, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(removed, 0) AS removed
  FROM d LEFT JOIN covered USING (r) LEFT JOIN dups USING (r) LEFT JOIN removed USING (r)),
based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND 100 * removed <= 50 * n_words AS kept
FROM based""",
    "op9_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op13_phrases": r"""
WITH pieces AS (
  SELECT row_number() OVER () AS r, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
runs AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT *, unnest([1, 2, 3]) AS k FROM places) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, phrase, k, CAST(count(*) AS HUGEINT) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS first, array_to_string(w[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates)),
scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000 * a * a // (x.f * y.f), c) AS nth
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.first
  JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
covered AS (
  SELECT lang, phrase, max(f) AS f
  FROM (SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM candidates WHERE k = 3)
  GROUP BY lang, phrase),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN covered v ON v.lang = s.lang AND v.phrase = s.phrase
  WHERE nth = 1 AND NOT coalesce(100 * v.f >= 50 * a, false))
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
