"""Corpus pipeline: from raw documents to packed windows of token ids.

Each stage takes the documents its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's documents. All but the last return
the columns of the table documents.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession

from visitlake.llm import packing, pii, quality, shingle_join
from visitlake.llm.components import stored
from visitlake.llm.workers import importable
from visitlake.session import prepare


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = importable(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return quality.kept(docs, quality.fit(docs, labels))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    importable(spark)
    return shingle_join.first_of_each(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the windows of token ids."""
    importable(spark)
    return packing.placed(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each_group),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Trained models, components and packing are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
