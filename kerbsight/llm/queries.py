"""The registered queries of this subpackage; ``ORACLES`` has the SQL of those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from kerbsight.llm.oracles import ORACLES
from kerbsight.session import scratch_root


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.ngram_jaccard import jaccard_components

    return jaccard_components(_table(spark, folder, "documents"))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.mixing import taken_words

    return taken_words(_table(spark, folder, "documents"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.quality import quality_scores

    return quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.embedding_codes import embedding_links

    return embedding_links(_table(spark, folder, "embeddings"))


def op7_token_huffman(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from kerbsight.llm.huffman import id_digests, write_ids

    files = f"{scratch_root(spark)}/kerbsight/token-files-{uuid.uuid4().hex}"
    write_ids(_table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), files)
    return id_digests(spark, files)


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.simhash_scan import contaminations

    return contaminations(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_lm_trie(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.lm_trie import lm_scores

    return lm_scores(_table(spark, folder, "documents"))


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.phrase_dedup import without_repeats

    return without_repeats(_table(spark, folder, "documents")).drop("kept")


def op9_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.chat_roles import chat_texts

    return chat_texts(_table(spark, folder, "conversations"))


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.license_scan import license_matches

    return license_matches(_table(spark, folder, "documents"))


def op11_block_search(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.term_blocks import ranked

    return ranked(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.target_ratio import rule_verdicts

    return rule_verdicts(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    from kerbsight.llm.turn_repair import conversation_audits

    return conversation_audits(_table(spark, folder, "conversations"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_source_mixing, op3_quality_classifier, op4_lm_trie, op5_substring_dedup,
        op6_embedding_near_dedup, op7_token_huffman, op8_benchmark_decontamination, op9_chat_formatting, op10_license_scan,
        op11_block_search, op12_quality_rules, op13_turn_repair,
        pipeline,
    )
}

__all__ = ["ORACLES", "QUERIES"]
