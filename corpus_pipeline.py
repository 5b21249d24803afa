"""A corpus pipeline over ``documents``: each stage takes what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.llm import decontaminate, jaccard_join, mixing, pii
from mapweave.llm import quality as resampling
from mapweave.llm.common import cut_lineage, read, settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that importance resampling draws.

    ``labels`` tells good from bad; without both nothing is rejected.  Rows
    with the same id and text stay or go together; an empty text has weight 0.
    """
    return resampling.keep(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group joined by 5-word shingles with a
    Jaccard similarity of 0.75 or more: the one with the smallest id.

    Every row counts by its own text, so one that shares its id with a copy, but
    is itself near nothing, stays.  Rows without id and documents without words
    belong to no group; each of them stays.
    """
    return jaccard_join.keep_first(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no part of a benchmark item."""
    return decontaminate.keep(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; every document stays."""
    settle(spark)
    return pii.redact(docs, pii.learn(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed blocks: ``shard``, ``slot``, ``source``, ``block_no``,
    ``part``, ``doc_id`` and ``text``; documents without words have no part."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: the stages learn models, which SQL cannot express; the tests hold them
#: against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents.  Each stage reads what the
    one before wrote into the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
    return docs
