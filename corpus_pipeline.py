"""A training corpus from raw documents: clean, deduplicate, decontaminate, mix and encode.

Every stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes each stage as
Parquet in the shared folder and reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulselake.llm import decontaminate, mixing, simhash, token_output, toxicity
from pulselake.llm.common import stored, table
from pulselake.llm.queries import vocabulary


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose nearest labelled examples do not make them toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of equal or nearly equal fingerprints."""
    return simhash.drop_near_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of their sources takes them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, stored and read back: place, length and checksum."""
    return token_output.encode_table(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token_output", encoded),
]

#: SQL has neither the nearest examples nor the tokenizer; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
