"""Corpus pipeline: from the documents table to packed training sequences.

Stages, each fed with what the one before kept (written as Parquet and read again): toxic documents go, documents of low
quality go, one document of each group of near duplicates stays, and the rest is packed into sequences of 1024 tokens.
All stages but the last return the columns of their input.  Nulls, empty texts, repeated rows and empty tables are
treated as the operators' docstrings say; of a group of near duplicates one row with the smallest id stays (rows without
an id only where no row of the group has one).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm import packing, quality, simhash, toxicity
from quartermaster.llm.common import prepare, table
from quartermaster.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    prepare(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality model does not reject."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (four-word shingles, four bits): the one with the smallest id."""
    prepare(spark)
    return simhash.keep_one(docs, words=4, max_bits=4)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, closing_id=2)


STAGES = [("toxicity", drop_toxic), ("quality", drop_low_quality), ("near_duplicates", drop_near_duplicates), ("packing", pack_sequences)]

#: Trained models, token merges and XXH64 are beyond SQL; the stages are tested against brute force and held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
