"""Corpus pipeline: documents -> training-order token shards.

Each stage works on all that its predecessor kept, is written as Parquet under the shared
folder, and is read again as the next stage's documents.  All but the last return the columns
of ``documents``; the last returns one row per packed sequence, read back from its shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hhlens.llm import decontamination, langid, mixing, simhash, token_output
from hhlens.llm.common import cut_lineage, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go."""
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (the smallest doc_id)."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out towards the sources' target weights."""
    return mixing.mix(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences in training order, written as fixed-stride shards."""
    return token_output.checked(token_output.write_shards(docs))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_shards", token_shards),
]

#: Trained language models, SimHash and tokenizers have no SQL; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
