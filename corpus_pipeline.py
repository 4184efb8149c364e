"""From raw documents to packed training sequences, in five stages.

1. Quality rules reject documents whose histograms lie far from every known language.
2. Near-duplicate groups, linked from a likeness of 0.8 on, are thinned to the document with the smallest id.
3. 100-byte strings that start earlier elsewhere are cut out.
4. Secrets are replaced by a mark.
5. What is left is packed into sequences of at most 4096 tokens.

Every stage takes the documents its predecessor kept and returns the same columns; the last
returns the pieces. Results are written between stages, below the shared checkpoint folder.
No stage can be put as SQL as a whole (suffix arrays, token ids); the tests hold each against
a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import minhash_dedup, quality_rules, retrieval_packing, secret_scan, substring_dedup
from tallyhouse.llm.common import documents, kept_table

ORACLE_SQL = None


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.drop_near_duplicates(docs)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return retrieval_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", good_documents),
    ("near-duplicates", one_of_each_group),
    ("repeated strings", without_repeated_strings),
    ("secrets", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
