"""The registered queries of this package; `ALL` maps a name to its Spark callable and its SQL, if any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    bpe,
    collocations,
    decontaminate,
    html_text,
    langid,
    license_scan,
    line_dedup,
    quality_model,
    quality_rules,
    simhash,
    substring_dedup,
    token_store,
    vector_codes,
)
from tidegate.queries.base import Query, table


def byte_level_bpe(spark: SparkSession, sf: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    model = langid.learn(documents.where(~langid.held_out()))
    return langid.predict(documents, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


def benchmark_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality_model.learn(documents, labels.where(~quality_model.held_out()))
    return quality_model.score(documents, model).select(
        "doc_id", quality_model.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents"))


def rule_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf, "documents"))


def token_ids(spark: SparkSession, sf: str) -> DataFrame:
    path = token_store.write_tokens(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.document_spans(spark, path)


def repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    # The words left, joined by one space, also where nothing was removed.
    spaced = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(spaced, "UTF-8"), 256).alias("kept_sha256"))


REPEATED_SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
starts AS (
  SELECT doc_id, unnest(range(1, len(words) - 18)) AS i FROM split WHERE len(words) >= 20),
keyed AS (
  SELECT s.doc_id, s.i, array_to_string(words[s.i:s.i + 19], ' ') AS w FROM starts s JOIN split USING (doc_id)),
later AS (
  SELECT doc_id, i FROM keyed
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS p FROM later, (SELECT unnest(range(0, 20)) AS d)),
places AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN n IS NULL THEN array_to_string(words, ' ')
              ELSE array_to_string(list_filter(words, lambda w, k: NOT list_contains(ps, k)), ' ') END) AS kept_sha256
FROM split LEFT JOIN places USING (doc_id)"""

_RULES_SQL = "\n          ".join(f"AND NOT ({rule.sql})" for rule in quality_rules.RULES)
CASCADE_SQL = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3)),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
signals AS (
  SELECT doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
          {_RULES_SQL} AS kept
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM signals)"""


def license_labels(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents"))


def vector_compression(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.coded(table(spark, sf, "embeddings"))


def shared_lines(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup.drop_shared_lines(table(spark, sf, "documents").select("doc_id", "text"))
    kept = F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256)
    return cleaned.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


ALL: dict[str, Query] = {
    "op1_byte_level_bpe": Query(byte_level_bpe),
    "op2_language_id": Query(language_id),
    "op3_html_extraction": Query(html_extraction),
    "op4_benchmark_decontamination": Query(benchmark_leaks),
    "op5_quality_classifier": Query(quality_classifier),
    "op6_simhash_near_dedup": Query(simhash_near_dedup),
    "op7_quality_rules": Query(rule_cascade, CASCADE_SQL),
    "op8_token_binary": Query(token_ids),
    "op9_substring_dedup": Query(repeated_passages, REPEATED_SQL),
    "op10_license_scan": Query(license_labels, license_scan.scan_sql()),
    "op11_vector_codes": Query(vector_compression, vector_codes.CODES_SQL),
    "op12_line_dedup": Query(shared_lines, line_dedup.LINES_SQL),
    "op13_phrase_collocations": Query(phrase_collocations, collocations.COLLOCATIONS_SQL),
}
