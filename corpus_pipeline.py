"""Corpus pipeline: quality, near-duplicates, benchmark leaks, mixture, training shards.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankloom.llm import decontaminate, mixing, quality, simhash
from rankloom.llm.queries import LANGUAGES, language_labels, training_shards
from rankloom.llm.registry import table
from rankloom.llm.tables import written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer rejects go."""
    return quality.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays at least once; rarer languages are repeated up to their weights."""
    labels = language_labels(docs, table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labels, LANGUAGES, least_rate=1.0)


def write_training_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token shards, one row for each sequence with the doc_ids in it."""
    return training_shards(spark, docs)


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_languages),
    ("token-ID / binary output", write_training_shards),
]

#: Fitted weights, fingerprints and token ids are beyond SQL; tests run the stages against plain
#: versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
