"""Training-corpus pipeline: quality rules, line dedup, near-duplicate
documents, source mix, packing.  Each stage works on all that its predecessor
kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelgrowth.llm import line_dedup, mix, ngram_join, packing, quality_rules
from panelgrowth.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.passing(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, words=5, percent=80, null_ids=True)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("mix_sources", mix_stage),
    ("best_fit_packing", packing_stage),
]

#: MinHash line dedup and best-fit packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
