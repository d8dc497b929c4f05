"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from fleetpulse.llm import (
    fixity, huffman, jaccard, licences, main_text, middles, negatives, neighbours, packing, simhash, suffix, tokens,
    weak_rules, winnowing,
)
from fleetpulse.llm.common import table
from fleetpulse.session import work_path, write_once


BYTE_TOKENIZER, BYTE_END = "byte_bpe_50k.json", 0
WORD_TOKENIZER, WORD_END = "word_bpe_49k.json", 2


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as byte-level ids, packed into sequences of at most 1024 tokens."""
    path = public_tokenizers.path(BYTE_TOKENIZER)
    ids = tokens.tokenize(table(spark, sf_dir, "documents"), path, "byte", BYTE_END)
    return packing.pack(ids, tokens.id_bytes(path)).withColumnRenamed("_id", "doc_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its nearest labelled ones, a fifth of the labels held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = neighbours.learn(docs, table(spark, sf_dir, "labels"))
    scored = neighbours.classify(docs, model)
    return scored.select("doc_id", neighbours.held_out().alias("held_out"), "score", "predicted")


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record of an archive, audited against a replica with faults.

    The replica follows from the pages: by the first two digits of the MD5 of its URL a record
    is lost (00), has its payload cut to half (01) or a changed last character (02).
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    mark = F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 2)
    size = F.length("html")
    other = (
        F.when(mark == "01", F.substring("html", F.lit(1), F.floor(size / 2).cast("int")))
        .when(mark == "02", F.concat(F.substring("html", F.lit(1), F.greatest(size - 1, F.lit(0))), F.lit("~")))
        .otherwise(F.col("html"))
    )
    record = fixity.record_bytes("page_id", "url", "html")
    changed = fixity.record_bytes("page_id", "url", "changed")
    hashed = pages.withColumns({"mark": mark, "changed": other}).select(
        "page_id", "url", "mark",
        F.octet_length(record).cast("bigint").alias("length"),
        F.sha2(record, 256).alias("digest"),
        F.octet_length(changed).cast("bigint").alias("other_length"),
        F.sha2(changed, 256).alias("other_digest"),
    )
    archive = write_once(fixity.layout(hashed, ["page_id", "url", "digest"]), "archive")
    replica = archive.where("mark <> '00'").select(
        "file", "offset", F.col("other_length").alias("length"), F.col("other_digest").alias("digest")
    )
    records = archive.select("page_id", "url", "file", "offset", "length", "digest")
    return fixity.audited(records, replica)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: 4-word shingles, 64 bits, links at 4 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each text without strings of 400 bytes that start elsewhere as well.

    n_passage_words counts the words in repeated passages of 50 words and more.
    """
    return suffix.deduplicate(table(spark, sf_dir, "documents"), passage_bytes=suffix.PASSAGE_BYTES)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families of which a document has a confirmed notice."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in a 10-word window of a benchmark item."""
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    joined = F.concat_ws(",", F.array_sort("items"))
    return found.withColumn("items_sha256", F.sha2(joined.cast("binary"), 256)).drop("items")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, rule votes and the posterior verdict of every document."""
    judged = weak_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as word-level ids, written to Huffman-coded files and read back from them."""
    path = public_tokenizers.path(WORD_TOKENIZER)
    ids = tokens.tokenize(table(spark, sf_dir, "documents"), path, "word", WORD_END)
    folder = work_path(spark, "token_files")
    width, size = tokens.id_bytes(path), tokens.vocabulary_size(path)
    huffman.write_files(write_once(ids, "token_ids"), width, size, folder)
    return huffman.read_files(spark, folder).select(
        F.col("_id").alias("doc_id"),
        "start",
        F.col("n").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score a little less than an anchor's positives."""
    return negatives.hard_negatives(negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut for filling in its middle, and the text rebuilt from the result."""
    made = middles.restored(middles.rearranged(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingles have nine tenths in common."""
    return jaccard.near_sets(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_quality_classifier": op2_quality_classifier,
        "op3_warc_fixity": op3_warc_fixity,
        "op4_simhash": op4_simhash,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_license_scan": op6_license_scan,
        "op7_decontamination": op7_decontamination,
        "op8_quality_rules": op8_quality_rules,
        "op9_token_files": op9_token_files,
        "op10_main_text": op10_main_text,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_ngram_jaccard": op13_ngram_jaccard,
    }
