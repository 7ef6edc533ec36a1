"""A corpus pipeline: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubagem.llm import decontamination, language_id, mixing, ngram_join, sharding
from cubagem.llm.common import table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; null texts and texts without a letter go, and nothing else.

    All with a letter stay where no row has a language to learn from.
    """
    samples = language_id.training_samples(docs)
    if not samples:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    predicted = language_id.identify(docs, samples, columns=True)
    kept = predicted.where(F.col("lang_pred") != language_id.UNDETERMINED)
    return kept.select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 75 % shared word shingles connect."""
    return ngram_join.keep_one(docs)


def remove_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without items of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate takes them."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's shard of nearly equal bytes, and its place there."""
    return sharding.shard_by_bytes(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_join", keep_one_of_near_copies),
    ("decontamination", remove_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL has no cross-parsing by suffix automata.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
