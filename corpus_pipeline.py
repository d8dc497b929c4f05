"""A training corpus from raw documents: five stages, each an operator of ``fleetpulse.llm``.

Every function takes (spark, docs, sf_dir) and returns a DataFrame. ``docs`` has the columns of the
documents table; so have the results of all stages but the last, which returns packed pieces.

Null ids, null and empty texts, very long texts and repeated rows go through every stage as the
operators define it; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import neighbours, packing, simhash, suffix, tokens, winnowing
from fleetpulse.llm.common import table, text_key
from fleetpulse.session import write_once

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. It learns from the labelled rows of its input."""
    slim = docs.select(*COLUMNS)
    model = neighbours.learn(slim, table(spark, sf_dir, "labels"))
    return neighbours.classify(slim, model).where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    A null id counts as larger than all others. Of rows with the same id the one whose text has
    the smallest key stays, and one of rows that are equal in both.
    """
    keyed = docs.select(
        *COLUMNS, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), text_key().alias("_key")
    )
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_id", "_key").alias("row")
    found = simhash.near_duplicates(keyed.select(row, "text"), "row")
    first = found.where(F.col("row") == F.col("component_id")).select("row._id", "row._key").distinct()
    return keyed.join(first, ["_id", "_key"]).dropDuplicates(["_id", "_key"]).select(*COLUMNS)


def repeat_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that occur elsewhere; documents left empty go."""
    cut = suffix.remove_repeats(docs.select(*COLUMNS), suffix.PASSAGE_BYTES, least_words=suffix.PASSAGE_WORDS)
    kept = cut.where((F.col("n_removed") == 0) | (F.length("text") > 0))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = winnowing.find_spans(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("items") == 0).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 byte-level ids, one row per piece of a document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = tokens.tokenize(docs, path, "byte", 0)
    return packing.pack(ids, tokens.id_bytes(path)).withColumnRenamed("_id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("repeat_dedup", repeat_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Trained models and suffix arrays are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table, each result stored before it is read on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
