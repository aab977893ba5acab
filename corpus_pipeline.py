"""A training corpus from raw documents: language, near copies, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage returns to the
shared folder and hands it on. All but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import bpe, decontaminate, langid, near_copies, substring_dedup
from tidegate.llm.stages import stored
from tidegate.queries.base import Query
from tidegate.session import tune


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language can be told, because they hold no letter, go."""
    tune(spark)
    model = langid.learn(docs.where(~langid.held_out()))
    return langid.known_language(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, 5-word Jaccard 0.8 or more, the document with the smallest id stays; of repeated rows one.

    A row without an id can't be told from others by it, so it stays.
    """
    tune(spark)
    groups = near_copies.near_copies(docs)
    first = groups.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi")
    kept = kept.withColumn("_near_dedup", F.xxhash64("text")).dropDuplicates(["doc_id", "_near_dedup"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred before are cut out of their documents; a document with no word left goes."""
    tune(spark)
    cleaned = substring_dedup.remove_repeats(docs).where("n_removed = 0 OR n_removed < n_words")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("n_chars")))
    return cleaned.select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, tune(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    tune(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("language ID", language_id),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup_stage),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding", bpe_encoding),
]

#: SQL can't express the language model, the fingerprints or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE = {"pipeline": Query(run, ORACLE_SQL)}
