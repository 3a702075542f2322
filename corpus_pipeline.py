"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Each stage works on all rows that the stage before kept. All but the last return the columns
of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from annolake.llm import mixing, packing, pii, quality, simhash
from annolake.llm.common import table
from annolake.session import checkpoint_dir

SHINGLE, MAX_BITS = simhash.SHINGLE, simhash.MAX_BITS


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on the labelled rows among ``docs``."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs, shingle=SHINGLE, max_bits=MAX_BITS)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    return pii.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens, one row a piece, with its ids (little-endian 32-bit)."""
    return packing.pack(docs, with_ids=True)


STAGES = [("quality_classifier", quality_stage), ("simhash_near_dedup", near_dedup_stage), ("personal_data", personal_data_stage),
          ("source_mix", mix_stage), ("packing", pack_stage)]

# A trained classifier, fingerprints and tokenizer ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; what a stage returns is written in the shared folder and read as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
