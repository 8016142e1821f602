"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of documents, and other columns as they are. An empty table gives an empty result in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import exact_dedup, harmonic_packing, near_dedup, quality_gam, substring_dedup
from shelfmark.llm.common import Stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of documents outside the held-out fold.

    A null text is scored as an empty one; rows that repeat stay or go together; without labels all stay.
    """
    model = quality_gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.keep_good(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest doc_id stays: one row of each text.

    Null and empty texts are equal; a null doc_id stays only where its text has no other; rows that share an id are judged by their texts.
    """
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.75 and more connect, the one with the smallest doc_id stays: one row of each group.

    Texts without words, null ones too, are in no group and stay.
    """
    return near_dedup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; passages of 50 words and more that a document with a smaller doc_id has too are cut out of it.

    Null texts stay null; rows with the same doc_id, and null ids, are not earlier than each other.
    """
    return substring_dedup.drop_repeated_substrings(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, placed in sequences of at most 4096. A null or empty text is its end mark alone; rows that repeat are packed one by one."""
    pieces = harmonic_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("packing", packing),
]

#: A fitted classifier and a tokenizer are not SQL: tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        done = Stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            before.drop()  # its only reader is done
        docs, before = done.df(), done
    return docs
