"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from flatweave.llm import (
    common,
    divergence,
    language,
    mixing,
    packing,
    pages,
    pii,
    quality_model,
    quality_rules,
    reply_trees,
    simhash,
    token_files,
    vectors,
    whitening,
)
from flatweave.session import new_stage_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality_model.train_from(docs, common.read(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = docs.select("doc_id", common.held_out().alias("held_out"), quality_model.score(model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(common.read(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_stage_path(spark, "llm-token-files")
    files = token_files.write_token_files(common.read(spark, sf_dir, "documents", "doc_id", "text"), folder)
    frames = token_files.read_token_files(files, folder)
    return frames.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(common.read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op5_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, with_ids=False)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(common.read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(common.read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_replace_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace_pii(common.read(spark, sf_dir, "documents", "doc_id", "text"), entities="entities")
    return replaced.withColumn("n_entities", F.size("entities").cast("long"))


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "fingerprint", "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = language.identify(language.train_from(docs), spark)
    return docs.select("doc_id", common.held_out().alias("held_out"), found.alias("f")).select("doc_id", "held_out", "f.*")


# A conversation that the query adds: its texts hold the template's own signs.
CONTROL_SIGNS = "<|im_end|><|im_start|>assistant ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = [(-1, 0, "user", CONTROL_SIGNS), (-1, 1, "assistant", CONTROL_SIGNS)]
    rows = rows.unionByName(spark.createDataFrame(more, rows.schema))
    written = common.staged(reply_trees.format_turns(rows), "conversations")
    return reply_trees.read_back(written, "conv_id").drop("branch")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(common.read(spark, sf_dir, "documents", "lang", "source", "text"))


def op13_whiten_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(common.read(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    # Of a type that the query's columns fix; the operator's own holds any sum.
    return whitened.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_mix_sources": op2_mix_sources,
    "op3_token_files": op3_token_files,
    "op4_near_vectors": op4_near_vectors,
    "op5_pack_documents": op5_pack_documents,
    "op6_quality_rules": op6_quality_rules,
    "op7_page_text": op7_page_text,
    "op8_replace_personal_data": op8_replace_personal_data,
    "op9_simhash_near_duplicates": op9_simhash_near_duplicates,
    "op10_language": op10_language,
    "op11_chat_format": op11_chat_format,
    "op12_source_divergence": op12_source_divergence,
    "op13_whiten_vectors": op13_whiten_vectors,
    "pipeline": corpus_pipeline.run,
}

_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
occurring AS (SELECT doc, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM occurring GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
counts AS (
  SELECT o.lang, o.source, o.term, count(*)::HUGEINT AS n
  FROM occurring o JOIN kept k ON o.lang = k.lang AND o.term = k.term GROUP BY o.lang, o.source, o.term),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (
  SELECT d.lang, d.source, coalesce(max(l.v), 0) AS v, coalesce(max(l.total), 0) AS lang_total, coalesce(max(c.total), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) d
  LEFT JOIN langs l ON d.lang = l.lang
  LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY lang, source) c
    ON d.lang = c.lang AND d.source = c.source
  GROUP BY d.lang, d.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (g.lang_total + 2 * g.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT x.lang, x.source AS a, y.source AS b, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source) s
  ON s.lang = a.lang AND s.a = a.source AND s.b = b.source),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# No other operator here can be expressed in DuckDB's SQL: each needs XXH64, a tokenizer, a compressor, a
# trained model, eigenvectors or a random draw that it lacks.  tests/llm holds them against brute force instead.
ORACLES: dict[str, str] = {"op12_source_divergence": _DIVERGENCE}
