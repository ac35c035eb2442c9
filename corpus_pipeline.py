"""From raw documents to token ids: quality rules, near duplicates, personal data, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of ``documents``; the last returns the ids of every document.

Nulls, empty and very long texts, ties, copies and clashing columns are treated as the operators say: a null or
empty text fails the quality rules, of a group of near duplicates the row with the smallest id stays (one of
those with equal ids), a document that the mix takes twice comes out twice, and empty tables give
empty tables. Texts are worked on whole at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vintage.llm import bpe, mixing, pii, quality, simhash
from vintage.llm.queries import BYTE_VOCABULARY
from vintage.llm.staging import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(docs)


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def byte_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_VOCABULARY)
    coded = bpe.encode(docs, ["doc_id"], path, public_tokenizers.PATTERN)
    return coded.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("pii", personal_data),
    ("mixing", mixing_weights),
    ("byte-level bpe", byte_tokens),
]

#: SQL cannot express voting, fingerprints, pseudonyms and byte pairs; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = scratch(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
