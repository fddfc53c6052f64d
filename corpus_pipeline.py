"""Corpus pipeline: language ID, line dedup, near dedup, source mix and packing over `documents`.

Every stage takes (spark, docs, folder), works on all its predecessor kept and is written as Parquet
before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradewinds.llm import langid, linededup, mixing, neardup, packing
from tradewinds.llm.common import documents
from tradewinds.operators.materialise import materialise


def language_id(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of which a language can be told; those without a letter, with a score below 0.5, or unlike all labelled texts, go."""
    return langid.keep_identified(docs, least_score=0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated passages of two or more lines go whole, but for the first; documents of which nothing is left go."""
    return linededup.drop_repeated_lines(docs, whole=True)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return neardup.keep_first(docs, words=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources at weights 5, 2, 1, repeating, up to three times their size; documents repeat as taken."""
    return mixing.mix_documents(docs, weights=(5, 2, 1), share=1.0, most=3)


def best_fit_packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Learned language models, shingle sets of other hashes and tokenizers are not SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
