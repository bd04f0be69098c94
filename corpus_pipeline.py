"""A corpus made ready for training: documents in a known language, one of each group of near copies, without live
secrets, mixed to target weights, as pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigiltx.llm import jaccard, langid, mixing, secrets, sentence_pieces
from vigiltx.sources.shared import fresh_path

#: Ordering by these gives the mixed order.
PLACE = ["slot", "block_start"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are ``und`` or of whose n-grams no language knows 30 %; learned from labelled documents."""
    return langid.spoken(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the Jaccard similarity of five-word shingles, 0.8 or more, keeps the one of the least id."""
    return jaccard.one_of_each(docs)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts, but for values that many owners share."""
    return secrets.masked(docs).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place (slot, block_start) in the schedule that mixes sources by the root of their characters.

    The place goes on as columns: neither the files of a table nor the order they are read in keep an order of rows.
    """
    rows = mixing.mix(docs)
    return rows.drop(*(c for c in mixing.ADDED if c not in PLACE))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their texts, in the order of the schedule, which the columns ``PLACE`` also name."""
    return sentence_pieces.encode(docs.orderBy(*PLACE, "doc_id")).drop("text")


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_near_copies),
    ("secret_scans", secrets_masked),
    ("mixing", mixed),
    ("sentence_pieces", pieces),
]

#: Neither the language model nor the pieces can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
