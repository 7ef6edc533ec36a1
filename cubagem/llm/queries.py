"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cubagem.llm import (
    alignment,
    chat,
    decontamination,
    html_text,
    language_id,
    lm_scoring,
    mixing,
    neighbours,
    ngram_join,
    prefix_trie,
    sharding,
    substring_dedup,
    token_counts,
)
from cubagem.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vocabulary(name: str) -> str:
    """The path of a vocabulary file; the folder can be given by TOKENIZERS_DIR."""
    folder = os.environ.get("TOKENIZERS_DIR")
    return os.path.join(folder, name) if folder else public_tokenizers.path(name)


@query
def op1_ngram_join(spark, sf_dir):
    return ngram_join.link_documents(table(spark, sf_dir, "documents"))


@query
def op2_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = f"{chat.END}{chat.BEGIN}assistant ok"
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    return chat.read_back(chat.format_examples(rows.union(probe)))


@query
def op3_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


@query
def op4_lm_score(spark, sf_dir):
    scored = lm_scoring.score(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))
    return scored.drop("n_subwords")


@query
def op5_mix_sources(spark, sf_dir):
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.selectExpr("doc_id", "size", "source_size", "target", "size * copies AS taken", "source", "copies")


@query
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op7_shard(spark, sf_dir):
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"))


@query
def op8_decontaminate(spark, sf_dir):
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "share", "n_slots", "reparameterised")


@query
def op9_nearest(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query
def op10_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.build_trie(table(spark, sf_dir, "conversations"))


@query
def op12_align_tokenizers(spark, sf_dir):
    return alignment.align_tokenizers(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    )


@query
def op13_extract_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
