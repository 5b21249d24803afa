"""Registered queries of the subpackage and their SQL.

Every query applies one operator with production parameters to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.llm import chosen_path, decontaminate, jaccard_join, language, mixing, neighbours, pii, prefix_trie, quality, reversed_search, toxicity
from mapweave.llm import substring_dedup as substrings
from mapweave.llm import suffix_dedup as suffixes
from mapweave.llm.common import read, remainder
from mapweave.llm.oracles import ORACLES as ORACLES


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    labels = read(spark, folder, "labels", "doc_id", "toxic")
    model = toxicity.learn(docs, labels.filter(remainder("doc_id", 5) != 0))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return toxicity.score(docs.select("doc_id", held_out, "text"), model).drop("text")


def op2_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read(spark, folder, "embeddings", "vec_id", "embedding")
    return neighbours.search(vectors, vectors.filter("vec_id % 50 = 0"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return pii.digest(pii.find(docs, pii.learn(docs)))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(read(spark, folder, "documents", "doc_id", "text", "source"))


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digest(suffixes.suffix_dedup(read(spark, folder, "documents", "doc_id", "text")))


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark", "item_id", "text")
    found = decontaminate.find(docs, items)
    ids = F.array_sort(F.array_distinct("matches.item_id"))
    return found.select("doc_id", (F.size("matches") > 0).alias("contaminated"), ids.alias("items"), "matches")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digest(substrings.substring_dedup(read(spark, folder, "documents", "doc_id", "text")))


def op8_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(read(spark, folder, "documents", "doc_id", "text"))


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text", "lang")
    model = language.learn(docs.filter(remainder("doc_id", 3) != 1))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return language.identify(docs.select("doc_id", held_out, "text"), model).drop("text")


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "labels", "doc_id", "quality")
    return quality.resample(docs, labels)[0]


def op11_near_copies(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.join(read(spark, folder, "documents", "doc_id", "text"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, folder, "conversations", "conv_id", "turn", "role", "text"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return reversed_search.search(read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark", "item_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_neighbours": op2_neighbours,
    "op3_pii": op3_pii,
    "op4_mixing": op4_mixing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_language": op9_language,
    "op10_quality": op10_quality,
    "op11_near_copies": op11_near_copies,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_lexical_search": op13_lexical_search,
}
