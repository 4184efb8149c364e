"""Registered queries of this package: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import (hard_negatives, imatch, importance_sampling, language_id, lm_scoring, minhash_dedup, oracles, piece_lattice, quality_rules,
                            resharding, retrieval_packing, secret_scan, simhash_dedup, substring_dedup)
from tallyhouse.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op3_histogram_divergence": oracles.QUALITY,
    "op4_superminhash_dedup": oracles.NEAR_DUPLICATES,
    "op5_suffix_array_dedup": oracles.REPEATED_STRINGS,
    "op12_head_tail_resampling": oracles.RESAMPLED,
    "op13_segment_hard_negatives": oracles.HARD_NEGATIVES,
}


def query(name: str):
    def add(function):
        QUERIES[name] = function
        return function
    return add


@query("op1_retrieval_packing")
def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieval_packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op2_n_best_pieces")
def segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encoded(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query("op3_histogram_divergence")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(documents(spark, sf_dir)).drop("word_distance", "class_distance")


@query("op4_superminhash_dedup")
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(documents(spark, sf_dir)).drop("class_links")


@query("op5_suffix_array_dedup")
def repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.removal_report(documents(spark, sf_dir))


@query("op6_subword_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


@query("op7_flow_resharding")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.layout(documents(spark, sf_dir))


@query("op8_markov_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


@query("op9_imatch_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


@query("op10_elias_fano_lm")
def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(documents(spark, sf_dir))


@query("op11_pivot_simhash_dedup")
def close_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(documents(spark, sf_dir)).drop("class_size")


@query("op12_head_tail_resampling")
def resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_sampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op13_segment_hard_negatives")
def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
