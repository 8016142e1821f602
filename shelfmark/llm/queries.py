"""The queries over the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import bpe_automaton, exact_dedup, harmonic_packing, language_bigru, masked_lm, minhash, near_dedup, phrase_growth, quality_gam, ring_sharding, substring_dedup, toxicity_channel, wand_search


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op4_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring_sharding.ring_shards(documents(spark, sf_dir), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = harmonic_packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.score(docs, model)


def op10_language_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_bigru.languages(docs, language_bigru.train(docs))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = minhash.fingerprints(documents(spark, sf_dir))
    return made.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_substrings(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm.token_likelihood(documents(spark, sf_dir))


def op11_phrase_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_growth.collocations(documents(spark, sf_dir), least=100, top=2000)


def op12_toxicity_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity_channel.score(docs, toxicity_channel.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op13_wand_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wand_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_harmonic_packing": op3_harmonic_packing,
    "op5_masked_lm": op5_masked_lm,
    "op6_minhash": op6_minhash,
    "op7_quality_gam": op7_quality_gam,
    "op10_language_bigru": op10_language_bigru,
    "op8_near_dedup": op8_near_dedup,
    "op9_bpe_automaton": op9_bpe_automaton,
    "op4_ring_sharding": op4_ring_sharding,
    "op11_phrase_growth": op11_phrase_growth,
    "op12_toxicity_channel": op12_toxicity_channel,
    "op13_wand_search": op13_wand_search,
}
