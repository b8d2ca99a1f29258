"""The corpus pipeline: from raw documents to packed training sequences.

Each stage calls one operator of ``netvigil.llm``, is written as Parquet and read
again as the documents of the next one. Rejected documents leave the corpus for
good; the last stage returns the places of the pieces of all that are left.

A stage gives, for an empty table, an empty table; nulls and clashing columns are
handled as its operator's docstring says. A document whose text is null is
scored, compared and packed as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from netvigil.llm import best_fit_packing, exact_dedup, pu_toxicity, quality_gam, signature_join
from netvigil.llm.common import read_table
from netvigil.session import fresh_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_gam.accepted(docs, quality_gam.train(docs, read_table(spark, sf_dir, "labels")))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return pu_toxicity.not_toxic(docs, pu_toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.deduplicate(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return signature_join.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 4096 tokens."""
    return best_fit_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("packing", packed),
]

# Trained models, tokenisers and connected components have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
