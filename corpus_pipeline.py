"""Documents to a tokenised training mix: the stages, and a run over the documents of a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loadkit.checks import workspace
from loadkit.llm.exact_dedup import DigestIndex, unique_rows
from loadkit.llm.jaccard import one_of_each_group
from loadkit.llm.language import known_language
from loadkit.llm.mixing import mixed_rows
from loadkit.llm.pieces import encode_pieces
from loadkit.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected stay."""
    return known_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays: the longest, then the one with the smallest id."""
    index = DigestIndex(spark, f"{workspace(spark)}.digests")
    return unique_rows(docs, index, "pipeline", without_id=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return one_of_each_group(docs, without_id=True)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it."""
    return mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the ids of their pieces."""
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language id", language_id),
    ("exact dedup", exact_dedup),
    ("n-gram jaccard join", near_dedup),
    ("mixing", mixing),
    ("sentencepiece", encode),
]

#: The language stage and the pieces can't be expressed in SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each reads what the one before it wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
