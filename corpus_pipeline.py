"""From raw documents to packed sequences: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from urbanspark.llm import exact_dedup, mixing, ngram_join, packing, quality_model
from urbanspark.operators.tables import materialize

WORD_TOKENIZER = "word_bpe_49k.json"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_model.accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return ngram_join.one_per_component(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat_documents(docs, mixing.mix_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(WORD_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_exact_copies),
    ("n-gram jaccard join", drop_near_copies),
    ("source mix", mix_sources),
    ("best-fit packing", pack_sequences),
]

# The trained scores and the random draws have no form in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
