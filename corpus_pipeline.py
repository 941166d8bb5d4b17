"""The corpus pipeline: four stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a runner may write
each result and read it back.  All but the last return the columns of ``documents``.

1. quality: the compression classifier, fitted on the labelled documents; a document
   scored below 0.7 goes.
2. near_dedup: the chosen-path join over word shingles; of each group of near
   duplicates one row stays, of the smallest id.
3. pii: personal data, disguised or plain, is masked in the text, and ``n_chars``
   follows the text.
4. packing: tokenised, cost-balanced sequences of at most 1024 ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import compression_quality, pii
from lodestar.llm.chosen_path import near_duplicates
from lodestar.llm.packing import pack_documents
from lodestar.llm.queries import PACKING_VOCABULARY
from lodestar.session import ship
from lodestar.storage import Scratch
from lodestar.tables import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; a null text counts as an empty one."""
    model = compression_quality.fit(docs, table(ship(spark), sf_dir, "labels"))
    return compression_quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates. Documents without words all stay.

    Rows are told apart by a number of their own: of rows that share an id, each is
    judged by its own text, and of repeated rows one stays.  In a group the row of the
    smallest id stays, a row with a null id only if the group has no other.
    """
    scratch = Scratch(ship(spark), "neardedup")
    row = next(c for c in ("row", *(f"row{k}" for k in range(len(docs.columns)))) if c not in docs.columns)
    # saved with its number, so that every later read sees the same one
    numbered = scratch.save(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, id_col=row).where("n_shingles > 0").select(F.col("doc_id").alias(row), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    grouped = found.join(numbered.select(row, "doc_id"), row).withColumn("order", order)
    first = grouped.groupBy("component_id").agg(F.min("order").alias("first"))
    gone = grouped.join(first, "component_id").where("order <> first").select(row)
    return numbered.join(gone, row, "left_anti").select(docs.columns)


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data masked; a null text and its ``n_chars`` stay as they are."""
    ship(spark)
    masked = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return masked


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences, and their ids."""
    ship(spark)
    return pack_documents(docs, public_tokenizers.path(PACKING_VOCABULARY), public_tokenizers.PATTERN)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", mask_pii), ("packing", packing)]

#: SQL can't express the classifier, the transducers or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written to the shared folder, read again, and deleted after the next one."""
    ship(spark)
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.clear(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
