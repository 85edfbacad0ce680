"""From raw documents to token ids: the training-data operators in a row.

Each stage takes all that its predecessor kept. All but the last return the columns of ``documents``.

Cases: a null or empty text fails the quality rules; null languages and sources are groups of their own; null ids, and
ids that several texts share, are told apart by text in every stage; repeated rows stay once; further columns, of any
name, are carried up to the last stage, which returns doc_id, ids and n_tokens; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, exact_dedup, mixing, near_dedup, quality
from tidemark.llm.common import scratch, table
from tidemark.llm.queries import tokenizer_file
from tidemark.scratch import cleared, remove, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    return quality.keep(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id."""
    return exact_dedup.deduplicate(docs, keep="min")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles the one with the smallest id."""
    return near_dedup.keep_one(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document is repeated once for each epoch that takes it."""
    return mixing.mixed(docs, weights=(3, 1, 2), budget_percent=150, max_epochs=2)


def bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every document of the mix."""
    return bpe.encode(docs, bpe.build(spark, docs, tokenizer_file()))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("mixing sources", mix_sources),
    ("BPE encoding", bpe_ids),
]

#: SQL has neither the tokenizer nor the near-duplicate links at full size; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    return run_on(spark, table(spark, sf_dir, "documents"), sf_dir)


def run_on(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All stages over ``docs``. A stage's result is kept until the next one is written, its working tables until it is
    written itself; of the last stage, whose result is still to be read, they stay in the shared folder."""
    path = None
    for name, stage in STAGES[:-1]:
        before, path = path, scratch(spark, "pipeline-" + name.replace(" ", "-"))
        with cleared(spark):
            docs = written(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
