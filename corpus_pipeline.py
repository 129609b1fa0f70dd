"""Cleans ``documents`` and packs what is left, in five stages that each apply one of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketrank.llm import exactdedup, neardedup, packing, repetition, toxicity
from basketrank.llm.common import ship, staged, table

#: Words that a packing worker remembers: its executor's memory is what four stages before have left.
REMEMBERED = 100_000

# Stages have no equivalent in SQL: suffix arrays, a trained classifier, MinHash and a tokenizer.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the repetition rules go."""
    ship(spark)
    return repetition.clean_rows(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression, fitted on the labelled ones among them, calls toxic go."""
    ship(spark)
    return toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for white space) the one with the smallest id stays."""
    ship(spark)
    return exactdedup.distinct_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 the one with the smallest id stays."""
    ship(spark)
    return neardedup.representatives(docs, size=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=REMEMBERED)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
