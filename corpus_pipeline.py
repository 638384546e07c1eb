"""A training corpus from documents: clean, deduplicate, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of the documents, without the rows the stage rejects. Between stages the rows are written as Parquet
to the shared checkpoint folder and read again, so a lost executor costs one stage's work at most.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foghorn.llm import divergence, naming, packing, simhash, toxicity
from foghorn.llm.common import documents, table
from foghorn.llm.queries import TOKENIZER
from foghorn.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores under one half; it learns from all of ``docs``."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def drop_irregular(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are close enough to a language reference."""
    return divergence.keep_regular(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return naming.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest id."""
    return simhash.keep_one_per_component(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.pack_examples(docs, public_tokenizers.path(TOKENIZER)).drop("loss_tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_irregular),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: SQL expresses neither the machine's training nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
