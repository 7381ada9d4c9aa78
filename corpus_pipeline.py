"""A corpus from documents to token ids: clean, deduplicate, mix, encode. Part of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwright.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from loomwright.llm.support import documents, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the toxicity classifier does not reject."""
    return toxicity.clean_rows(docs, toxicity.fitted(docs, toxicity.labels_table(spark, sf_dir)))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that 5-gram Jaccard of 0.8 or more links."""
    return ngram_join.kept_of_groups(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture by source takes them."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of each row."""
    return bpe.round_trip(docs, with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_join", without_near_copies),
    ("mixing", mixed),
    ("bpe", encoded),
]

#: The first stage learns a classifier, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet in the shared folder and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
