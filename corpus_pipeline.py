"""A training-data pipeline over the documents table: each stage is an operator of ``pacewatch.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pacewatch.llm import bpe, exact_dedup, mixing, quality, simhash_dedup
from pacewatch.llm.common import stored, table
from pacewatch.llm.queries import tokenizer_spec

# SQL can express neither the classifier, the permutations of the mix nor the tokens; the
# tests hold each stage against a brute-force version.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the pairwise quality model accepts; it learns from the labels outside its held-out fold."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z the largest doc_id stays."""
    return exact_dedup.drop_repeats(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints that links of three bits join up the smallest doc_id stays."""
    return simhash_dedup.drop_near(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each document and epoch that takes of it."""
    return mixing.mixed_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of the ids and of what they decode to."""
    return bpe.tokenized(docs, tokenizer_spec())


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
