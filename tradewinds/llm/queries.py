"""One query per text operator over whole `documents`, the pipeline, and the SQL that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tradewinds.llm import filteraudit, fingerprints, langid, licenses, linededup, mixing, neardup, packing, phrases, quality, secretscan, sharding, tokencount
from tradewinds.llm.common import documents
from tradewinds.llm.oracle import EXPECTED
from tradewinds.operators.materialise import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
__all__ = ["EXPECTED", "QUERIES"]


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = tokencount.from_file(public_tokenizers.path("piece_bpe_32k.model"), scores="zipf")
    return tokencount.token_counts(documents(spark, folder), vocabulary)


@query
def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), weights=(5, 2, 1), share=1.0, most=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(documents(spark, folder), folds=5)


@query
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(documents(spark, folder))


@query
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(documents(spark, folder), tokenizer=tokenizer, end_id=2, capacity=1024)


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(documents(spark, folder))


@query
def op7_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_report(documents(spark, folder))


@query
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.dedup_lines(documents(spark, folder), whole=True)


@query
def op9_minimax_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.shard(documents(spark, folder), 8)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, folder), words=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query
def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(documents(spark, folder), longest=4, least=30, percent=80, top=2000)


@query
def op12_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secretscan.digest(materialise(secretscan.scan(documents(spark, folder))))


@query
def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return filteraudit.audit(documents(spark, folder), labels)


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
