"""The registered queries of this subpackage and, where SQL can express one, its DuckDB statement."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import compression_quality, html_extract, license_rules, sql
from lodestar.llm.bpe_pieces import encode_digests
from lodestar.llm.chat_collapse import collapse
from lodestar.llm.chosen_path import near_duplicates
from lodestar.llm.packing import pack_documents
from lodestar.llm.pii import pii_spans
from lodestar.llm.sorted_projection import near_vectors
from lodestar.llm.threshold_topk import top_k
from lodestar.tables import table

PACKING_VOCABULARY = "byte_bpe_50k.json"
ENCODING_RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_pii_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_quality.score(docs, compression_quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(PACKING_VOCABULARY), public_tokenizers.PATTERN, with_ids=False)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(table(spark, sf_dir, "conversations"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(ENCODING_RANKS), public_tokenizers.PATTERN)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan(table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii_deobfuscation,
        op2_embedding_near_dedup,
        op3_quality_classifier,
        op4_packing,
        op5_chat_formatting,
        op6_byte_bpe,
        op7_license_scan,
        op8_exact_top_k,
        op9_html_extraction,
        op10_minhash_near_dedup,
    )
}

ORACLE_SQL = {
    "op2_embedding_near_dedup": sql.OP2,
    "op5_chat_formatting": sql.OP5,
    "op7_license_scan": license_rules.oracle_sql(),
    "op8_exact_top_k": sql.OP8,
    "op10_minhash_near_dedup": sql.OP10,
}
