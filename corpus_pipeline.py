"""Corpus pipeline: each stage reads what the one before it kept, as Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import bin_slack, bpe, parity, quality, winnow
from corpusloom.llm.common import table
from corpusloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their compression bands."""
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of similar ones: five-word shingles, similarity 0.8."""
    return parity.keep_one(docs, parity.Join(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule does not mark."""
    return winnow.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 ids, with a checksum of each piece's ids."""
    pieces = bin_slack.pack(docs, bin_slack.Packing(bpe.tokenizer_path(), capacity=2048, end_id=1))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: SQL has neither Zstandard nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences of what the stages keep of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, "stage-" + name.replace(" ", "-"))
    return docs
