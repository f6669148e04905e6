"""Corpus pipeline: toxic, foreign, repeated and near-duplicate text goes, the rest is packed into sequences.

Every stage is a function (spark, docs, sf_dir) -> DataFrame and works on all rows that the one before kept.  All but
the last return the columns of ``documents``; the last returns one row for each packed piece.  Models are learned from the rows that the
stage is given, outside the held-out fold, and from the ``labels`` table of the folder.

Null or empty texts pass the first stage and leave at the second, which knows no language for them.  A text that
loses all its lines stays, empty.  Rows with the same id are one document to the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrina.llm import language_id, line_dedup, near_dedup, packing, toxicity
from vitrina.llm.common import shared_table, table

#: A document leaves as of unknown language if its best language has a smaller share of its words.
LEAST_LANGUAGE_SHARE = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic"))


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.with_language(docs, language_id.fit(docs), least_score=LEAST_LANGUAGE_SHARE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicated(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.without_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: SQL can express neither the learned stages nor the tokeniser; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents in ``sf_dir``; every stage's rows are stored and read back by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
