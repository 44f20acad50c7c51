"""Training corpus from raw documents: language, near copies, repeated passages, benchmark passages, mix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.functions.workspace import materialize
from shelfcast.llm import contamination, language_id, minhash_join, mixing, recompression

#: No source rules, every document is used, none more than twice.
MIX = mixing.Target(entropy=0.95, max_repeats=2.0)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without letters, or between languages, go."""
    return language_id.keep_known(docs, language_id.train(docs))


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every class of near copies."""
    return minhash_join.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of thirteen words or more that an earlier document holds."""
    return recompression.remove_repeats(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages; documents that are benchmark text for the most part go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return contamination.remove_passages(docs, benchmark)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every use of a document in the mix of sources, with its place in the order."""
    return mixing.mixed_documents(docs, MIX)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each_class),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("source_mixing", mixed),
]

#: The language model cannot be said in SQL; tests hold the result against a plain walk through the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each reads what the one before it has written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
