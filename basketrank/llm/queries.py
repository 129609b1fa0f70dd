"""The corpus operators as queries over the whole driver tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, decontaminate, exactdedup, fim, htmltext, licenses, neardedup, packing, prefixtrie, pseudolm, repetition, tokencount, toxicity,
)
from .common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudolm.lm_scores(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.fill_in_middle(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_token_counts, op2_byte_bpe, op3_lm_score, op4_exact_dedup, op5_minhash_near_dedup, op6_license_scan,
        op7_html_text, op8_packing, op9_toxicity, op10_quality_rules, op11_prefix_trie, op12_decontamination,
        op13_fill_in_middle,
    )
}
ORACLE: dict[str, str] = {
    "op4_exact_dedup": r"""
        WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS own FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(own) AS text_sha256
        FROM texts WINDOW same AS (PARTITION BY own)
    """,
    "op6_license_scan": licenses.oracle_sql(),
    "op11_prefix_trie": prefixtrie.oracle_sql(),
    "op12_decontamination": decontaminate.oracle_sql(),
    "op13_fill_in_middle": fim.oracle_sql(),
}
