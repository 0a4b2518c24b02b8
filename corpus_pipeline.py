"""The corpus pipeline: from `documents` to packed sequences.

Each stage gets what its predecessor kept, and its decisions take effect:
rejected documents go, one document of each near-duplicate group stays, repeated
and benchmark passages are cut from the texts, and the rest is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pavestone.llm.decontaminate import remove_hits
from pavestone.llm.jaccard import first_of_each
from pavestone.llm.packing import pack_documents
from pavestone.llm.quality import kept_documents
from pavestone.llm.substrings import remove_repeats
from pavestone.storage import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on repeated n-grams and lines keep."""
    return kept_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of the smallest doc_id."""
    return first_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that occur earlier."""
    return remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages."""
    return remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 2048 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: SQL can't express the tokens and the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of `documents`; every stage is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
