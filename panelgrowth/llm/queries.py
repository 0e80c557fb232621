"""The registered queries of this package: each applies one operator, with its
production parameters, to its whole table."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from panelgrowth.llm import (
    embed_dedup, kd_shards, lexical, line_dedup, mix, ngram_join, packing, quality_classifier, quality_rules, repeats,
    token_align, token_files, warc,
)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix.mix_plan(_read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op2_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_read(spark, sf_dir, "documents"))


def op2_maximal_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.maximal_repeats(_read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents")).drop("js_chars", "js_words")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(_read(spark, sf_dir, "documents"), tokenizer_file())


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(_read(spark, sf_dir, "documents"))


def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(_read(spark, sf_dir, "pages"))


def op7_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_read(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(_read(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_read(spark, sf_dir, "documents"))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.align_tokens(_read(spark, sf_dir, "documents"), tokenizer_file(),
                                    tokenizer_file("piece_bpe_32k.model"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.kd_shards(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_mix_sources, op2_remove_repeats, op2_maximal_repeats, op3_quality_rules, op4_token_files,
        op5_best_fit_packing, op6_warc_archives, op7_embedding_near_dup, op8_line_dedup,
        op9_quality_classifier, op10_ngram_join, op11_token_align, op12_lexical_search, op13_kd_shards)}

ORACLES: dict[str, str] = {"op12_lexical_search": lexical.ORACLE_SQL}
