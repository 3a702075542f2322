"""Registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annolake.llm import align, langid, mixing, packing, pages, periodic, pii, quality, rules, simhash, topk, vectors, viterbi
from annolake.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op4_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.embedding_components(table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(table(spark, sf_dir, "documents"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return pages.extract(p, pages.fit(p))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_quality_rules, op3_simhash_near_duplicates, op4_embedding_near_duplicates,
    op5_language_id, op6_personal_data, op7_token_counts, op8_main_text, op9_source_mix, op10_packing, op11_top_k_search,
    op12_tokenizer_alignment, op13_periodic_runs)}
